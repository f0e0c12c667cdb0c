"""hourgrid: Spark-native analytics for hourly consumption/production series.

Subpackages
-----------
sources    readers, declared schemas and sinks (CSV, JSON map, Parquet, tables)
functions  column expressions: time arithmetic, calendar, unit conversions
operators  cleaning, joins, aggregations, time-series windows
plans      the feature pipeline, the SQL-style reports and the backtest
streaming  incremental (per availability block) loading of the fact table

Every operator takes column names as parameters and returns a lazy DataFrame,
so Catalyst sees one plan from scan to sink.
"""

from hourgrid.session import checkpoint_dir, get_session, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
