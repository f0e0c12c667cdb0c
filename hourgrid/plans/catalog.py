"""Registered queries: one per operator group of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame computed
from the driver tables (through the stand-ins). Column names match the
oracle SQL in ``oracle_queries.py``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions import calendar as cal
from hourgrid.functions import scalar as fx
from hourgrid.functions.scalar import shift_time
from hourgrid.operators import aggregate as agg
from hourgrid.operators import clean
from hourgrid.operators.aggregate import county_mean, pivot_any, rounded
from hourgrid.operators.clean import clean_series_nulls
from hourgrid.operators.joins import duplicate_keys
from hourgrid.operators.timeseries import add_lags, add_lags_and_rollings, add_sliding_median, fill_segment, interpolate_segment, keep_last
from hourgrid.plans import backtest as bt
from hourgrid.plans import boosting
from hourgrid.plans import report_sql as rsql
from hourgrid.plans import reports, standins
from hourgrid.plans.boosting import BoostParams, boost
from hourgrid.sources.readers import read_table
from hourgrid.plans.features import (
    LAG_SPECS_FEATURES,
    MergeKeys,
    add_ratio_features,
    add_time_features,
    merge_alternate,
    merge_fact,
    prepare_holidays,
)

Query = Callable[[SparkSession, str], DataFrame]

HOURLY_KEYS = MergeKeys(unit=("event_type",), county="event_type")


def _hour_price_prepared(spark: SparkSession, d: str) -> DataFrame:
    hp = standins.hour_price(spark, d)
    return hp.select(shift_time("origin_date", "2d").alias("datetime"), "euros_per_mwh", "data_block_id")


def merged_hourly(spark: SparkSession, d: str) -> DataFrame:
    """J1 client, J2 gas, J3 electricity (+2 days), J8 holiday flags; F1."""
    h = standins.hourly(spark, d).withColumn("date", F.to_date("datetime"))
    hol = pivot_any(standins.flags(spark, d).select("date", "holiday_type"), "date", "holiday_type",
                    standins.EVENT_TYPES)
    return merge_fact(
        h, standins.daily_dim(spark, d), standins.daily_price(spark, d), _hour_price_prepared(spark, d),
        holidays=hol, keys=HOURLY_KEYS,
    )


def _money(df: DataFrame) -> DataFrame:
    """Sums rounded for the comparison with the oracle; the reports themselves don't round them."""
    return df.withColumns({c: rounded(c, 4) for c in ("consumption", "MoM_diff", "total_target") if c in df.columns})


def monthly_change(spark: SparkSession, d: str) -> DataFrame:
    """A7 + W1: monthly totals of final orders and month-over-month change."""
    o = standins.orders_fact(spark, d)
    return _money(reports.monthly_change(o, "o_orderdate", "o_totalprice", F.col("is_final"), name="consumption"))


# ------------------------------------------------------------- time series

SERIES = ["event_type"]
ROLL_SPECS = {
    "2d": {"6h": ["mean", "std", "median", "count"], "24h": ["mean"], "168h": ["mean"]},
    "3d": None,
    "7d": {"12h": ["mean", "std"]},
}


def _round_new(df: DataFrame, before: list[str], k: int = 4) -> DataFrame:
    """Round the new floating columns (engine-stable comparison)."""
    fl = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[rounded(c, k).alias(c) if c not in before and c in fl else F.col(c) for c in df.columns])


def lag_rolling_features(spark: SparkSession, d: str) -> DataFrame:
    """W3 + W4: exact lags 2d/3d/7d and [t-w, t) rollings over the lag columns."""
    h = standins.hourly(spark, d).select("event_type", "datetime", "target")
    out = add_lags_and_rollings(h, "target", ROLL_SPECS, "datetime", SERIES, bucket="auto", dtype=None)
    return _round_new(out, h.columns)


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: merged hourly table + DST/calendar + lags/rollings + ratios."""
    m = merged_hourly(spark, d)
    base = m.columns
    out = add_time_features(m)
    out = add_lags_and_rollings(out, "target", LAG_SPECS_FEATURES, "datetime", SERIES, dtype=None)
    out = add_ratio_features(out)
    keep = base + ["dst", "hour", "day_of_week", "month", "quarter", "day_of_month", "day_of_year", "week_of_year"]
    return _round_new(out, keep)


def capacity_fill(spark: SparkSession, d: str) -> DataFrame:
    """Back-fill, forward-fill inside the series, then 1.0."""
    h = standins.holes(spark, d).select("event_type", "datetime", "target")
    return fill_segment(h, "target", "datetime", SERIES, default=1.0, out_col="target_filled", bucket_days=3)


def interpolate_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Linear interpolation by row position inside each series."""
    h = standins.holes(spark, d).select("event_type", "datetime", "target")
    out = interpolate_segment(h, "target", "datetime", SERIES, out_col="target_interp", bucket_days=3)
    return out.withColumn("target_interp", rounded("target_interp", 4))


def clean_train(spark: SparkSession, d: str) -> DataFrame:
    """P15 (+P3 path): drop every second NULL timestamp, interpolate the rest."""
    h = standins.holes(spark, d).select("event_type", "datetime", "target")
    out = clean_series_nulls(h, "datetime", "target", SERIES)
    return out.withColumn("target", rounded("target", 4))


# ------------------------------------------------------------- weather

WEATHER_MEASURES = ["quantity", "price", "discount", "tax"]


def _round_cols(df: DataFrame, cols: list[str], k: int = 4) -> DataFrame:
    return df.withColumns({c: rounded(c, k) for c in cols})


def forecast_county(spark: SparkSession, d: str) -> DataFrame:
    """A1 + J9: county and overall (label 12) means in one grouping-sets pass."""
    agg = county_mean(standins.forecast_grid(spark, d), standins.stations(spark, d), ["station"], "county")
    return _round_cols(agg, WEATHER_MEASURES)


def _forecast_dedup(spark: SparkSession, d: str) -> DataFrame:
    agg = county_mean(standins.forecast_grid(spark, d), standins.stations(spark, d), ["station"], "county")
    return keep_last(agg, ["county", "forecast_datetime", "data_block_id"], ["origin_datetime", "hours_ahead"])


def forecast_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Keep the latest origin (then longest horizon) per forecast hour and block."""
    return _round_cols(_forecast_dedup(spark, d), WEATHER_MEASURES)


def _history_county(spark: SparkSession, d: str) -> DataFrame:
    return county_mean(standins.history_grid(spark, d), standins.stations(spark, d), ["station"], "county")


def history_county(spark: SparkSession, d: str) -> DataFrame:
    """A1 on point readings (time keys: datetime, block)."""
    return _round_cols(_history_county(spark, d), WEATHER_MEASURES)


def weather_joined(spark: SparkSession, d: str) -> DataFrame:
    """f0d (forecast + 1 day), f1d, h2d (+2 days, block + 1 up to 10:00), h1d (+1 day)."""
    fact = standins.county_fact(spark, d)
    out = merge_fact(fact, forecast=_forecast_dedup(spark, d), historical=_history_county(spark, d),
                     keys=MergeKeys(unit=("county",)))
    meas = [c for c in out.columns if c.split("_", 1)[-1] in WEATHER_MEASURES and "_" in c]
    return _round_cols(out, meas)


def weather_forecast_joined(spark: SparkSession, d: str) -> DataFrame:
    """J4 + J5: the forecast as tomorrow's feature (+ 1 day) and unshifted; one measure of each."""
    out = merge_fact(standins.county_fact(spark, d), forecast=_forecast_dedup(spark, d), keys=MergeKeys(unit=("county",)))
    return _round_cols(out.select("county", "datetime", "f0d_price", "f1d_price"), ["f0d_price", "f1d_price"])


def weather_history_joined(spark: SparkSession, d: str) -> DataFrame:
    """J6 + J7: readings of two days ago, with the block shift up to 10:00, and of one day ago; one measure of each."""
    out = merge_fact(standins.county_fact(spark, d), historical=_history_county(spark, d), keys=MergeKeys(unit=("county",)))
    return _round_cols(out.select("county", "datetime", "h2d_price", "h1d_price"), ["h2d_price", "h1d_price"])


def weather_joined_alt(spark: SparkSession, d: str) -> DataFrame:
    """Alternate merge with an inner join type, f1_ unshifted, h2_ without block."""
    fact = standins.county_fact(spark, d)
    fc = county_mean(standins.forecast_grid(spark, d), standins.stations(spark, d), ["station"], "county")
    out = merge_alternate(fact, forecast=fc, historical=_history_county(spark, d), how="inner",
                          keys=MergeKeys(unit=("county",)))
    meas = [c for c in out.columns if c.split("_", 1)[-1] in WEATHER_MEASURES and "_" in c]
    return _round_cols(out, meas)


def forecast_county_union(spark: SparkSession, d: str) -> DataFrame:
    """The two-aggregate + UNION ALL form of A1 (differential to the grouping-sets form)."""
    fg = standins.forecast_grid(spark, d)
    st = standins.stations(spark, d).filter(F.col("county") != 12).select("station", "county")
    mapped = fg.join(st, ["station"], "inner")
    tk = agg.weather_time_keys(fg.columns)
    means = [F.avg(m).alias(m) for m in WEATHER_MEASURES]
    overall = mapped.groupBy(*tk).agg(*means).withColumn("county", F.lit(12).cast("int"))
    per = mapped.groupBy("county", *tk).agg(*means)
    return _round_cols(agg.union_all([overall.select("county", *tk, *WEATHER_MEASURES), per]), WEATHER_MEASURES)


def dedupe_readings(spark: SparkSession, d: str) -> DataFrame:
    """One reading per (station, datetime, block); smallest measures win."""
    hg = standins.history_grid(spark, d)
    return clean.dedupe_on_keys(hg, ["station", "datetime", "data_block_id"])


# ------------------------------------------------------------- reports


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return standins.orders_fact(spark, d)


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    """A2: NULL counts per column of the merged table, one pass."""
    cols = ["target", "datetime", "eic_count", "installed_capacity", "lowest_price_per_mwh",
            "highest_price_per_mwh", "euros_per_mwh"]
    return reports.null_report(merged_hourly(spark, d), cols)


def column_profile(spark: SparkSession, d: str) -> DataFrame:
    """Non-null count and type per column."""
    return agg.column_profile(merged_hourly(spark, d))


def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """O1: ORDER BY six columns LIMIT 5."""
    return reports.first_rows(merged_hourly(spark, d),
                              ["datetime", "event_type", "is_consumption", "target", "n", "eic_count"], 5)


def series_completeness(spark: SparkSession, d: str) -> DataFrame:
    """A3: non-null values per (user, event type) series, summarised."""
    ev = read_events(spark, d)
    return reports.series_completeness(ev, ["user_id", "event_type"], "value")


def read_events(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events")


def avg_monthly_by_flag(spark: SparkSession, d: str) -> DataFrame:
    """A4: average monthly total per flag, rounded, in millions."""
    return reports.avg_monthly_total(_orders(spark, d), "o_orderdate", "o_totalprice", "is_final")


def growth_rate(spark: SparkSession, d: str) -> DataFrame:
    """A5 (+J10, F13): compound annual growth between first and last timestamp."""
    return reports.growth_rate(_orders(spark, d), "o_orderdate", "o_totalprice")


def category_segment(spark: SparkSession, d: str) -> DataFrame:
    """A6 for the segment column."""
    return _money(reports.category_summary(_orders(spark, d), "c_mktsegment", "is_final", "o_totalprice"))


def category_priority(spark: SparkSession, d: str) -> DataFrame:
    """A6 for the priority column."""
    return _money(reports.category_summary(_orders(spark, d), "o_orderpriority", "is_final", "o_totalprice"))


def category_nation(spark: SparkSession, d: str) -> DataFrame:
    """A6 for the nation column."""
    return _money(reports.category_summary(_orders(spark, d), "c_nationkey", "is_final", "o_totalprice"))


def category_all(spark: SparkSession, d: str) -> DataFrame:
    """A6 for all three category columns from one grouping-sets aggregate."""
    return _money(reports.category_summaries(_orders(spark, d), ["c_mktsegment", "o_orderpriority", "c_nationkey"],
                                             "is_final", "o_totalprice"))


def top5_month(spark: SparkSession, d: str) -> DataFrame:
    """O2 + P9: top-5 (nation, segment) totals of final orders in March 1996."""
    return _money(reports.top_groups_in_period(_orders(spark, d), ["c_nationkey", "c_mktsegment"], "o_orderdate",
                                               "o_totalprice", "1996-03-01", "1996-04-01", F.col("is_final"), 5))


def daily_moving_avg(spark: SparkSession, d: str) -> DataFrame:
    """A8 + W2: daily totals, 3/7-row means, then the March 1996 filter."""
    out = reports.daily_moving_averages(_orders(spark, d), "o_orderdate", "o_totalprice", "1996-03-01",
                                        "1996-04-01", F.col("is_final") & (F.col("c_mktsegment") == "BUILDING"))
    return _money(out).withColumns({c: rounded(c, 4) for c in ["consumption_MA_3d", "consumption_MA_7d"]})


def holiday_pivot(spark: SparkSession, d: str) -> DataFrame:
    """One boolean column per flag type, absent → False."""
    return prepare_holidays(standins.flags(spark, d), standins.EVENT_TYPES)


# ------------------------------------------------------------- functions


def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    """F3 + F4 + F5 on event timestamps."""
    ev = read_events(spark, d).select("event_id", "ts")
    out = cal.add_cyclic_features(ev, "ts", drop_raw=False).withColumn("dst", cal.dst_flag("ts"))
    cyc_cols = [c for c in out.columns if c.endswith("_sin") or c.endswith("_cos")]
    return out.withColumns({c: rounded(F.col(c).cast("double"), 4) for c in cyc_cols})


def calendar_years(spark: SparkSession, d: str) -> DataFrame:
    """F3 + F4 over seven years in both DST states: ship times moved to 2019-2025, three hours per line."""
    li = from_table(spark, d, "lineitem")
    moved = F.timestamp_add("YEAR", F.lit(27), F.col("l_shipdate"))
    ts = F.timestamp_add("HOUR", (F.col("l_linenumber") * 3).cast("int"), moved)
    out = li.select("l_orderkey", "l_linenumber", ts.alias("ts"))
    return cal.add_calendar_features(out, "ts").withColumn("dst", cal.dst_flag("ts"))


def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    """F1, F2, F6-F11, F13, F14, F16-F19 on lineitem columns."""
    li = from_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fx.shift_time("l_shipdate", "36h").alias("ship_plus_36h"),
        fx.trunc_ts("month", "l_shipdate").alias("ship_month"),
        fx.to_day("l_shipdate").alias("ship_day"),
        fx.grid_key(F.col("l_discount") * 10 + 55.0).alias("grid_lat"),
        fx.zero_below(fx.m_to_mm(F.col("l_tax") / 100.0), 0.1).alias("precip_mm"),
        rounded(fx.wind_speed("l_quantity", F.col("l_discount") * 100), 6).alias("windspeed"),
        rounded(fx.wind_u("l_quantity", F.col("l_linenumber") * 45), 6).alias("u_component"),
        rounded(fx.wind_v("l_quantity", F.col("l_linenumber") * 45), 6).alias("v_component"),
        fx.clip_lower(F.col("l_extendedprice") - 50000.0, 0.0).alias("clipped"),
        rounded(fx.snow_cm_to_mm("l_tax"), 6).alias("snow_mm"),
        rounded(fx.safe_ratio("l_extendedprice", "l_discount"), 4).alias("price_per_discount"),
        fx.abs_error("l_extendedprice", F.col("l_quantity") * 1000.0).alias("abs_err"),
        F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("label"),
        fx.round_half_even(F.col("l_extendedprice").cast("decimal(18,2)"), 1).cast("double").alias("price_even"),
        fx.round_half_up(F.col("l_extendedprice").cast("decimal(18,2)"), 1).cast("double").alias("price_up"),
        fx.elapsed_seconds(F.lit("1995-01-01").cast("timestamp_ntz"), "l_shipdate").alias("elapsed_s"),
        (F.col("l_shipdate") + fx.hours_to_interval("l_linenumber")).alias("ship_plus_lines_h"),
    )


def from_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def yield_target(spark: SparkSession, d: str) -> DataFrame:
    """production yield = target / max(capacity, 1), and its inverse."""
    m = merged_hourly(spark, d).select("event_type", "datetime", "target", "installed_capacity", "is_consumption")
    y = fx.yield_of("target", "installed_capacity", "is_consumption")
    return m.select("event_type", "datetime", rounded(y, 6).alias("yield"),
                    rounded(fx.from_yield(y, "installed_capacity"), 4).alias("target_back"))


# ------------------------------------------------------------- small relational ops


def time_span(spark: SparkSession, d: str) -> DataFrame:
    """A10: first/last timestamp and span."""
    return agg.time_span(standins.hourly(spark, d), "datetime")


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per value."""
    return agg.value_counts(from_table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values / distinct NULL timestamps."""
    h = standins.holes(spark, d)
    return agg.distinct_values(h.filter(F.col("target").isNull()), ["datetime"])


def range_filter(spark: SparkSession, d: str) -> DataFrame:
    """Equality + inclusive time range."""
    return clean.between(standins.hourly(spark, d), "datetime", "2024-01-08 00:00:00", "2024-01-14 23:00:00",
                         event_type="click")


def not_null_filter(spark: SparkSession, d: str) -> DataFrame:
    """P10: IS NOT NULL."""
    return clean.not_null(standins.holes(spark, d), "target")


def drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    """P3 + P1: project, then drop rows with any NULL/NaN in the projected set."""
    h = clean.project(standins.holes(spark, d), ["event_type", "datetime", "target", "data_block_id"])
    return clean.drop_null_rows(h)


def day_partition_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S5 + S7: write the hourly fact partitioned by day (shared checkpoint folder), read one week back.

    The read is partition-pruned: only the directories of the requested days
    are listed and scanned.
    """
    import uuid

    from hourgrid.session import checkpoint_dir
    from hourgrid.sources import sinks

    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/hourly-days-{uuid.uuid4().hex}"
    sinks.write_partitioned_by_day(standins.hourly(spark, d), path)
    return sinks.read_day_range(spark, path, "2024-01-03", "2024-01-10")


def clustered_range(spark: SparkSession, d: str) -> DataFrame:
    """Line items written clustered by supplier and ship time, a range of both read back."""
    from hourgrid.sources import sinks

    path = _scratch_path(spark, "clustered")
    li = from_table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_linenumber", "l_quantity", "l_extendedprice")
    sinks.write_clustered(li, path, "l_suppkey", "l_shipdate", files=32)
    return sinks.read_clustered(spark, path, "l_suppkey", (10, 40), "l_shipdate", "1996-01-01", "1997-01-01")


def _scratch_path(spark: SparkSession, name: str) -> str:
    import uuid

    from hourgrid.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as CSV with a header, read back with a declared schema (no inference)."""
    from hourgrid.sources.readers import read_csv_table

    path = _scratch_path(spark, "orders-csv")
    from_table(spark, d, "orders").write.mode("overwrite").option("header", True).csv(path)
    return read_csv_table(spark, path, ORDERS_SCHEMA)


FLAG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
    T.StructField("is_high", T.BooleanType()), T.StructField("is_view", T.BooleanType()),
])


def csv_flags_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Flags written as 0/1 and true/false, columns in another order and one too many; read by name."""
    from hourgrid.sources.readers import read_csv_table

    ev = read_events(spark, d)
    path = _scratch_path(spark, "events-csv")
    ev.select((F.col("event_type") == "view").alias("is_view"), "value", F.col("user_id").alias("spare"),
              F.when(F.col("value") >= 100, 1).otherwise(0).alias("is_high"), "event_id", "ts").write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    return read_csv_table(spark, path, FLAG_SCHEMA)


def negated_list(spark: SparkSession, d: str) -> DataFrame:
    """A negated literal list keeps rows without a value."""
    ev = read_events(spark, d).select("event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"))
    return clean.semi_filter(ev, ["view", "error"], "kind", negate=True)


def null_group_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of a group whose key is NULL."""
    ev = read_events(spark, d).select("value", F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"))
    return _round_cols(agg.exact_percentiles(ev, ["kind"], "value", [0.25, 0.5, 0.9]), ["p25", "p50", "p90"])


def fine_sums(spark: SparkSession, d: str) -> DataFrame:
    """Sums of small values with many decimals."""
    li = from_table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_tax") / 1000.0).alias("share"))
    out = reports.category_summary(li, "l_returnflag", "l_linestatus", "share").select("l_returnflag", "l_linestatus", "total_target")
    return _round_cols(out, ["total_target"], 5)


def station_names(spark: SparkSession, d: str) -> DataFrame:
    """F12 + S5: lower-cased names of the stations, written with overwrite and read back."""
    from hourgrid.sources import sinks

    path = _scratch_path(spark, "stations")
    sinks.write_overwrite(standins.stations(spark, d), path)
    return spark.read.parquet(path)


def declared_tables(spark: SparkSession, d: str) -> DataFrame:
    """The hourly table, dropped and recreated, and read by name."""
    from hourgrid.sources import sinks

    name = "hourgrid_hourly"  # one name; its files are in the shared folder and go with it
    sinks.replace_table(standins.hourly(spark, d).select("event_type", "datetime", "target", "n"), name, _scratch_path(spark, "declared"))
    return spark.read.table(name)


def ddl_gas_prices(spark: SparkSession, d: str) -> DataFrame:
    """S4 + S5: gas prices loaded twice into the table that the declared DDL creates; its types are the declared ones."""
    from hourgrid.sources import sinks

    p = standins.daily_price(spark, d)
    day = F.date_add(F.lit(standins.EVENT_BASE).cast("date"), F.col("data_block_id") - 1)
    rows = p.select((F.col("data_block_id").cast("long") * 1).alias("data_block_id"), day.alias("origin_date"), F.date_add(day, 1).alias("forecast_date"),
                    "highest_price_per_mwh", "lowest_price_per_mwh")
    spark.sql("DROP TABLE IF EXISTS hourgrid_gas_prices")
    path = _scratch_path(spark, "gas-prices")
    for _ in range(2):
        sinks.load_declared(rows, "gas_prices", "hourgrid_gas_prices", path)
    return spark.read.table("hourgrid_gas_prices")


def ddl_clients(spark: SparkSession, d: str) -> DataFrame:
    """Clients under the declared schema: customers by nation and segment, one row per order day."""
    from hourgrid.sources import sinks

    o = _orders(spark, d).filter("c_nationkey IS NOT NULL")
    segment = F.dense_rank().over(Window.orderBy("c_mktsegment")).alias("product_type")
    kinds = o.select("c_mktsegment").distinct().select("c_mktsegment", segment)
    rows = o.join(kinds, "c_mktsegment").groupBy("product_type", F.col("c_nationkey").alias("county"), F.col("is_final").alias("is_business"),
                                                 F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("eic_count"), rounded(agg.total("o_totalprice"), 2).alias("installed_capacity"))
    rows = rows.withColumn("data_block_id", F.datediff("date", F.lit(standins.LINE_BASE).cast("date")))
    spark.sql("DROP TABLE IF EXISTS hourgrid_client")
    sinks.load_declared(rows, "client", "hourgrid_client", _scratch_path(spark, "clients"))
    return spark.read.table("hourgrid_client")


def versioned_reload(spark: SparkSession, d: str) -> DataFrame:
    """S5 + S6: a table reloaded from itself: the second version reads the first one that it replaces."""
    from hourgrid.sources import sinks

    path = _scratch_path(spark, "versions")
    sinks.publish_version(standins.hourly(spark, d).select("event_type", "datetime", "n"), path)
    old = sinks.read_version(spark, path)
    sinks.publish_version(old.filter("n > 1").withColumn("n", F.col("n") * 10), path)
    return sinks.read_version(spark, path)


def holdout_remainder(spark: SparkSession, d: str) -> DataFrame:
    """T4: every row with the part it falls into, the md5-ordered sample or the remainder."""
    h = standins.hourly(spark, d).select("event_type", "datetime")
    sample, rest = bt.holdout_split(h, 100, ["event_type", "datetime"])
    return sample.withColumn("part", F.lit("sample")).unionByName(rest.withColumn("part", F.lit("rest")))


def column_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Non-null values per categorical column of the orders table."""
    o = _orders(spark, d)
    cats = clean.categorical_columns(o, ["c_nationkey"])
    return agg.column_profile(o.select(*cats)).select("column", "non_null", "dtype")


def linear_trend(spark: SparkSession, d: str) -> DataFrame:
    """M1: an unregularised one-feature linear fit of price on quantity; its slope and intercept."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    li = from_table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(li)
    m = LinearRegression(labelCol="y", solver="normal").fit(rows)
    n = from_table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))
    return n.select("n", rounded(F.lit(float(m.coefficients[0])), 2).alias("slope"), rounded(F.lit(float(m.intercept)), 1).alias("intercept"))


def json_map_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """An id → name JSON object (nation → "name:customers"), parsed back into rows.

    The labels aggregate the whole customer table (the work grows with the
    data); the object itself has one entry per nation, so the single task
    that assembles and writes it handles a bounded, 25-entry document.
    """
    from hourgrid.sources.readers import read_id_name_map

    path = _scratch_path(spark, "nation-json")
    per_nation = from_table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers"))
    n = from_table(spark, d, "nation").join(
        per_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    label = F.concat(F.col("n_name"), F.lit(":"), F.coalesce(F.col("n_customers"), F.lit(0)).cast("string"))
    obj = n.agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.col("n_nationkey").cast("string"), label)))).alias("value"))
    obj.coalesce(1).write.mode("overwrite").text(path)
    return read_id_name_map(spark, path, "county", "county_name")


def semi_join_filter(spark: SparkSession, d: str) -> DataFrame:
    """Membership in a computed key set (left semi join)."""
    o = from_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keys = from_table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return clean.semi_filter(o, keys, "o_custkey")


def anti_join_filter(spark: SparkSession, d: str) -> DataFrame:
    """Negated membership (left anti join) and a literal isin."""
    o = from_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    keys = from_table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    out = clean.semi_filter(o, keys, "o_custkey", negate=True)
    return clean.semi_filter(out, ["1-URGENT", "2-HIGH"], "o_orderpriority")


def train_window(spark: SparkSession, d: str) -> DataFrame:
    """P14 (+P7): rows of a time window with helper columns dropped."""
    return clean.split_features_target(standins.hourly(spark, d), "datetime", "2024-01-08 00:00:00",
                                       "2024-01-21 23:00:00", to_drop=["n", "data_block_id"])


def top_bottom_items(spark: SparkSession, d: str) -> DataFrame:
    """A17 (+O3): mean per (group, item) and the first/last 5 items of each group."""
    li = from_table(spark, d, "lineitem").select("l_returnflag", "l_suppkey", "l_quantity")
    out = agg.top_bottom_by_group(li, ["l_returnflag"], "l_suppkey", "l_quantity", 5)
    return out.withColumn("mean_l_quantity", rounded("mean_l_quantity", 6))


def duplicate_line_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys that break a declared uniqueness, with multiplicity."""
    return duplicate_keys(from_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def cast_and_fill(spark: SparkSession, d: str) -> DataFrame:
    """P2 + P4 + P5: declared casts, constant NULL fill, renames on the merged table."""
    m = merged_hourly(spark, d).select("event_type", "datetime", "eic_count", "installed_capacity", "n")
    m = clean.cast_columns(m, {"eic_count": "double", "n": "int"})
    m = clean.fill_constants(m, {"eic_count": 0.0, "installed_capacity": 1.0})
    return clean.rename(m, {"eic_count": "eic", "installed_capacity": "capacity"})


# ------------------------------------------------------------- backtest


FOLD_ARGS = dict(train_share=0.64, val_share=0.16, n_val_splits=3, n_test_splits=3, fh=2)
EVAL_DAYS = 3


def month_folds(spark: SparkSession, d: str) -> DataFrame:
    """Expanding month folds from the first order date."""
    return bt.month_folds(_orders(spark, d), "o_orderdate", train_range=60, test_range=1, shift=1, splits=4)


def _hourly_folds(spark: SparkSession, d: str) -> DataFrame:
    # The bounds need only the first and last hour: taken from the event
    # times directly (a partial min/max), not from the hourly aggregate.
    hours = read_events(spark, d).select(fx.trunc_ts("hour", "ts").alias("datetime"))
    return bt.share_folds(hours, "datetime", **FOLD_ARGS)


def share_folds(spark: SparkSession, d: str) -> DataFrame:
    """Validation and test folds from day shares."""
    return _hourly_folds(spark, d)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption")
    lagged = add_lags(h, "target", ["2d", "7d"], "datetime", SERIES)
    return bt.assign_folds(lagged, _hourly_folds(spark, d), "datetime", eval_days=EVAL_DAYS)


def fold_membership(spark: SparkSession, d: str) -> DataFrame:
    """Every row with its folds and its part (train / eval / test)."""
    return _labelled(spark, d).select("event_type", "datetime", "kind", "fold", "part")


def eval_holdout(spark: SparkSession, d: str) -> DataFrame:
    """T4: seeded sample of 100 rows, stable under any partitioning."""
    return bt.sample_holdout(standins.hourly(spark, d), 100, ["event_type", "datetime"], seed=10)


def naive_scores(spark: SparkSession, d: str) -> DataFrame:
    """M5 + A14: 2-day-lag forecast, MAE per fold, flag and part."""
    pred = bt.naive_predictions(_labelled(spark, d), "target_lag_2d")
    return _round_cols(bt.fold_scores(pred, ["kind", "fold", "is_consumption", "part"]), ["mae"])


def naive_scores_sliced(spark: SparkSession, d: str) -> DataFrame:
    """T3 + A14: the scores of ``naive_scores`` with each row read once: sums per time slice, folds as ranges of slices."""
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption")
    pred = bt.naive_predictions(add_lags(h, "target", ["2d"], "datetime", SERIES), "target_lag_2d")
    return _round_cols(bt.fold_scores_by_slices(pred, _hourly_folds(spark, d), "datetime", ["is_consumption"], EVAL_DAYS), ["mae"])


def mae_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Train and test MAE side by side and their ratio."""
    pred = bt.naive_predictions(_labelled(spark, d), "target_lag_2d")
    sc = bt.fold_scores(pred, ["kind", "fold", "is_consumption", "part"])
    out = agg.train_test_ratio(sc, ["kind", "fold", "is_consumption"], "part", "mae")
    return _round_cols(out, ["train_mae", "test_mae", "ratio"])


def error_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """P50/P60/P75 of the absolute error on test rows."""
    pred = bt.naive_predictions(_labelled(spark, d), "target_lag_2d").filter(F.col("part") == "test")
    out = agg.error_percentiles(pred, ["is_consumption"], "target", "preds")
    return _round_cols(out, ["p50", "p60", "p75"])


def sketched_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """A3 + A15: percentiles of prices per customer segment from monthly KLL sketches, and whether their rank errors keep the bound."""
    o = _orders(spark, d).withColumn("month", fx.trunc_ts("month", "o_orderdate"))
    qs = [0.05, 0.25, 0.5, 0.75, 0.95]
    merged = agg.merge_sketches(agg.percentile_sketches(o, ["c_mktsegment", "month"], "o_totalprice"), ["c_mktsegment"])
    off = agg.rank_errors(o, ["c_mktsegment"], "o_totalprice", agg.sketch_percentiles(merged, qs), qs)
    return off.join(merged.select("c_mktsegment", "n"), "c_mktsegment").select("c_mktsegment", "q", "n", (F.col("rank_error") <= 0.02).alias("within"))


def residuals_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Mean absolute error by hour of day and weekday, per flag."""
    pred = bt.naive_predictions(_labelled(spark, d), "target_lag_2d").filter(F.col("part") == "test")
    e = fx.abs_error("target", "preds")
    out = pred.groupBy("is_consumption", F.hour("datetime").alias("hour"),
                       F.weekday("datetime").alias("day_of_week")).agg(F.avg(e).alias("mae"))
    return _round_cols(out, ["mae"])


def residuals_weekly(spark: SparkSession, d: str) -> DataFrame:
    """Mean absolute error per Sunday-ending week and series."""
    pred = bt.naive_predictions(_labelled(spark, d), "target_lag_2d").filter(F.col("part") == "test")
    e = fx.abs_error("target", "preds")
    out = pred.groupBy("event_type", agg.weekly_bin("datetime").alias("week")).agg(F.avg(e).alias("mae"))
    return _round_cols(out, ["mae"])


def score_compare(spark: SparkSession, d: str) -> DataFrame:
    """Two score tables joined on (fold, segment)."""
    lab = _labelled(spark, d).filter(F.col("part") == "test")
    keys = ["kind", "fold", "is_consumption"]
    s2 = bt.fold_scores(bt.naive_predictions(lab, "target_lag_2d"), keys).withColumnsRenamed(
        {"mae": "mae_lag_2d", "n_scored": "n_lag_2d"})
    s7 = bt.fold_scores(bt.naive_predictions(lab, "target_lag_7d"), keys).withColumnsRenamed(
        {"mae": "mae_lag_7d", "n_scored": "n_lag_7d"})
    return _round_cols(s2.join(s7, keys, "left"), ["mae_lag_2d", "mae_lag_7d"])


def best_lag(spark: SparkSession, d: str) -> DataFrame:
    """M6: the selection step over lag baselines: mean MAE over validation folds, the best candidate marked."""
    lab = _labelled(spark, d).filter((F.col("part") == "test") & (F.col("kind") == "val"))
    per_fold = agg.union_all([
        bt.fold_scores(bt.naive_predictions(lab, f"target_lag_{lag}"), ["fold"]).withColumn("model_label", F.lit(f"lag_{lag}")) for lag in ("2d", "7d")])
    per_cand = per_fold.groupBy("model_label").agg(F.avg("mae").alias("mean_mae"), F.count(F.lit(1)).cast("long").alias("n_folds"))
    best = per_cand.agg(F.min_by("model_label", "mean_mae")).scalar()
    return _round_cols(per_cand.withColumn("is_best", F.col("model_label") == best), ["mean_mae"])


def prediction_rows(spark: SparkSession, d: str) -> DataFrame:
    """M1 + M3 + M4: keys and targets of the prediction table, one row per test row, fold and segment."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption")
    frame = add_lags(h, "target", ["2d", "7d"], "datetime", SERIES)
    preds = bt.backtest_models(frame, folds, "datetime", ["is_consumption"], [bt.FitSpec("linear", "linear", {"maxIter": 10})], eval_days=EVAL_DAYS)
    return preds.select("event_type", "datetime", "kind", "fold", "is_consumption", "target", "model_label", F.col("preds").isNotNull().alias("scored"))


def _ml_frame(spark: SparkSession, d: str) -> DataFrame:
    """Hourly features for the learners: lags, rollings, calendar."""
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption")
    out = add_lags_and_rollings(h, "target", {"2d": {"6h": ["mean"], "24h": ["mean"]}, "3d": None,
                                              "7d": {"12h": ["mean"]}}, "datetime", SERIES)
    return cal.add_calendar_features(out, "datetime")


def gbt_backtest(spark: SparkSession, d: str) -> DataFrame:
    """M1 + M3 + M4: GBT per (fold, flag) with early stopping; prediction table."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    preds = bt.backtest_models(_ml_frame(spark, d), folds, "datetime", ["is_consumption"],
                               [bt.FitSpec("gbt_abs", "gbt", {"lossType": "absolute", "maxIter": 10})],
                               eval_days=EVAL_DAYS)
    return preds.withColumn("abs_error", fx.abs_error("target", "preds"))


#: Rounds at most, patience and bins of the registered boosting queries on the hourly rows; the reference has 500 to 3,000 rounds and a patience of 100 to 200 (README).
ROUNDS, PATIENCE, BINS = 30, 10, 32


def _lag_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line prices with three features of few values, one of them missing on every third line."""
    li = from_table(spark, d, "lineitem")
    return li.select(F.col("l_extendedprice").alias("price"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("quantity"),
                     F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def _first_tree(spark: SparkSession, d: str):
    rows = _lag_rows(spark, d).withColumns({"model": F.lit(0), "part": F.lit("train")})
    return boost(rows, [BoostParams(rounds=1, learning_rate=1.0, max_depth=3, min_rows=50)], ["quantity", "discount", "tax"], "price").trees.filter("round = 1")


def boosted_tree(spark: SparkSession, d: str) -> DataFrame:
    """M1 + M7: one boosted tree over all lines: splits, the side of missing values, rows, gains and leaf values."""
    t = _first_tree(spark, d)
    finite = F.when(F.col("threshold") < float("inf"), F.col("threshold")).alias("threshold")
    return t.select("node", "feature", finite, "missing_left", "n_rows", rounded(F.col("gain") / 1e6, 2).alias("gain_millions"), rounded("value", 3).alias("value"))


def boosted_gains(spark: SparkSession, d: str) -> DataFrame:
    """M7: total gain, splits and rows per feature, by SQL over the stored tree."""
    from hourgrid.session import materialize

    stored = materialize(_first_tree(spark, d), "trees")
    sql = "SELECT feature, sum(gain) AS gain, count(*) AS n_splits, sum(n_rows) AS n_rows FROM {t} WHERE feature IS NOT NULL GROUP BY feature"
    return spark.sql(sql, t=stored).select("feature", rounded(F.col("gain") / 1e6, 2).alias("gain_millions"), "n_splits", "n_rows")


def _lag_errors(spark: SparkSession, d: str) -> DataFrame:
    """(l_returnflag, round, error): error of guessing a line's price from the supplier's mean over its first ``round`` line numbers."""
    li = from_table(spark, d, "lineitem")
    sums = li.groupBy("l_returnflag", F.col("l_linenumber").cast("int").alias("round")).agg(agg.total("l_extendedprice").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("l_returnflag").orderBy("round")
    whole = Window.partitionBy("l_returnflag")
    run = F.sum("s").over(w) / F.sum("n").over(w)
    mean = F.sum("s").over(whole) / F.sum("n").over(whole)
    return sums.select("l_returnflag", "round", rounded(F.abs(run - mean), 2).alias("error"))


def stopping_rounds(spark: SparkSession, d: str) -> DataFrame:
    """M3: the rounds that training with a patience of 2 keeps and stops at, from a table of round errors."""
    return boosting.stopping_rounds(_lag_errors(spark, d), ["l_returnflag"], patience=2)


def halving_rungs(spark: SparkSession, d: str) -> DataFrame:
    """M6: successive halving over eight lag baselines; rung r scores the survivors on r + 1 validation folds."""
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption")
    lags = [f"{k}d" for k in range(1, 9)]
    lab = bt.assign_folds(add_lags(h, "target", lags, "datetime", SERIES), _hourly_folds(spark, d).filter(F.col("kind") == "val"), "datetime", eval_days=None)
    test = lab.filter(F.col("part") == "test")
    long = test.select("fold", "target", F.explode(F.array(*[F.struct(F.lit(k + 1).alias("candidate"), F.col(f"target_lag_{lag}").alias("preds"))
                                                              for k, lag in enumerate(lags)])).alias("_")).select("fold", "target", "_.*").filter("preds IS NOT NULL")
    per_fold = bt.fold_scores(long, ["candidate", "fold"])
    scores = per_fold.select("*", F.explode(F.sequence("fold", F.lit(2))).alias("rung")).withColumnRenamed("mae", "error")
    return _round_cols(boosting.halving_survivors(scores, 3), ["mean_error"])


def boost_backtest(spark: SparkSession, d: str) -> DataFrame:
    """M1 + M3 + M4: boosted trees per (fold, flag), absolute loss, patience on the eval window; prediction table."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    out = bt.boosted_backtest(_ml_frame(spark, d), folds, "datetime", ["is_consumption"], {"boost_abs": BoostParams("absolute", ROUNDS, max_depth=4)},
                              eval_days=EVAL_DAYS, patience=PATIENCE, bins=BINS)
    return out.predictions.withColumn("abs_error", fx.abs_error("target", "preds"))


def objective_comparison(spark: SparkSession, d: str) -> DataFrame:
    """M2: absolute, squared, Huber and Tweedie trees; MAE per fold and flag, the best objective per flag."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    specs = {"absolute": BoostParams("absolute", ROUNDS, max_depth=4), "squared": BoostParams("squared", ROUNDS, max_depth=4),
             "huber_100": BoostParams("huber", ROUNDS, max_depth=4, alpha=100.0),
             **{f"tweedie_{p}": BoostParams("tweedie", ROUNDS, max_depth=4, power=p) for p in (1.35, 1.5, 1.65)}}
    out = bt.boosted_backtest(_ml_frame(spark, d), folds, "datetime", ["is_consumption"], specs, eval_days=EVAL_DAYS, patience=PATIENCE, bins=BINS)
    scores = bt.fold_scores(out.predictions, ["model_label", "kind", "fold", "is_consumption"])
    # the objective kept per segment: lowest mean MAE over the folds
    per_model = scores.groupBy("is_consumption", "model_label").agg(F.avg("mae").alias("_mean"))
    best = per_model.groupBy("is_consumption").agg(F.min_by("model_label", "_mean").alias("best_model_label"))
    return scores.join(best, "is_consumption").withColumn("is_best", F.col("model_label") == F.col("best_model_label"))


SEARCH_SPACE = {"max_depth": (3, 5), "learning_rate": (0.03, 0.3), "rows_share": (0.5, 1.0), "min_rows": (1, 20),
                "features_share": (0.4, 1.0), "l2": (0.0, 5.0)}


def _search(spark: SparkSession, d: str):
    """Eight candidates on all validation folds: rungs after 3, 6 and 12 rounds keep 4, 2 and 1 of them."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "val")
    drawn = bt.sample_candidates(SEARCH_SPACE, 8)
    specs = {c.label: BoostParams(rounds=ROUNDS, **c.params) for c in drawn}
    return specs, bt.boosted_backtest(_ml_frame(spark, d), folds, "datetime", [], specs, eval_days=None, halving=(3, 2), bins=BINS)


def param_search(spark: SparkSession, d: str) -> DataFrame:
    """M6: successive halving over eight seeded candidates on all validation folds: rungs, mean errors, survivors."""
    specs, out = _search(spark, d)
    shown = spark.createDataFrame([(name, json.dumps(asdict(p), sort_keys=True)) for name, p in specs.items()], "model_label string, params string")
    best = out.names[out.halving.winner()]
    return out.rungs().join(shown, "model_label").withColumn("is_best", F.col("model_label") == best)


def best_model_holdout(spark: SparkSession, d: str) -> DataFrame:
    """M6: refit the selected candidate on the test folds and score the holdout."""
    specs, out = _search(spark, d)
    name = out.names[out.halving.winner()]
    test = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    refit = bt.boosted_backtest(_ml_frame(spark, d), test, "datetime", [], {name: specs[name]}, eval_days=None, bins=BINS)
    return bt.fold_scores(refit.predictions, ["model_label", "kind", "fold"])


def gain_summary(spark: SparkSession, d: str) -> DataFrame:
    """M7 + A17: mean total gain per feature and segment over the folds; top and bottom 5 features."""
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    out = bt.boosted_backtest(_ml_frame(spark, d), folds, "datetime", ["is_consumption"], {"boost": BoostParams("squared", 10, max_depth=4)}, eval_days=EVAL_DAYS, bins=BINS)
    gains = out.gains(["is_consumption", "fold"]).withColumn("segment", F.col("is_consumption").cast("string"))
    return agg.top_bottom_by_group(gains, ["segment"], "feature", "gain", 5)


SUPPLIER_SPECS = {"7d": {"28d": ["mean", "std", "count"], "7d": ["median"]}, "28d": None, "364d": None}


def yield_backtest(spark: SparkSession, d: str) -> DataFrame:
    """W5 + F15 + M1 + A14: train on production yield, score in target units.

    Capacity is filled inside each series (back, forward, then 1.0); the
    model learns target / max(capacity, 1) on production rows; predictions
    are turned back into target units before the MAE.
    """
    m = merged_hourly(spark, d).select("event_type", "datetime", "target", "is_consumption", "installed_capacity",
                                       "eic_count", "euros_per_mwh")
    m = fill_segment(m, "installed_capacity", "datetime", SERIES, default=1.0, out_col="capacity")
    m = add_lags_and_rollings(m, "target", {"2d": {"24h": ["mean"]}, "7d": None}, "datetime", SERIES)
    prod = m.filter(~F.col("is_consumption")).withColumn(
        "yield", fx.yield_of("target", "capacity", "is_consumption"))
    folds = _hourly_folds(spark, d).filter(F.col("kind") == "test")
    preds = bt.backtest_models(prod, folds, "datetime", [], [bt.FitSpec("gbt_yield", "gbt", {"maxIter": 10})],
                               label="yield", exclude=["target", "installed_capacity"], eval_days=EVAL_DAYS)
    back = preds.withColumn("preds", fx.from_yield("preds", "capacity"))
    return bt.fold_scores(back, ["model_label", "kind", "fold"], "target")


def supplier_daily_features(spark: SparkSession, d: str) -> DataFrame:
    """W3 + W4 at scale: one daily series per supplier (grows with the data).

    Lags 7d/28d/364d and rollings over the 7-day lag; the halo-bucketed
    windows split every series into ~4x-halo time buckets.
    """
    li = from_table(spark, d, "lineitem")
    daily = li.groupBy("l_suppkey", F.col("l_shipdate").alias("day")).agg(
        rounded(agg.total("l_extendedprice"), 4).alias("revenue"))
    out = add_lags_and_rollings(daily, "revenue", SUPPLIER_SPECS, "day", ["l_suppkey"], dtype=None)
    return _round_new(out, daily.columns)


def sliding_median(spark: SparkSession, d: str) -> DataFrame:
    """The 28-day rolling median of each supplier's daily revenue, from histograms of the frames."""
    daily = from_table(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_shipdate").alias("day")).agg(rounded(agg.total("l_extendedprice"), 4).alias("revenue"))
    return _round_cols(add_sliding_median(daily, "revenue", "28d", "day", ["l_suppkey"], dtype=None), ["revenue_28d_win_median"])


def supplier_gbt_backtest(spark: SparkSession, d: str) -> DataFrame:
    """M1 + T1 at scale: one GBT per month fold on the supplier daily series (grows with the data).

    Features: lags 7d/28d/364d, rollings over the 7-day lag, calendar parts.
    Two expanding month folds (train 60 months, test the next month), no
    segmentation: one model per fold over all suppliers.
    """
    feats = cal.add_calendar_features(supplier_daily_features(spark, d), "day")
    # the fold bounds need only the first ship day, not the features
    folds = bt.month_folds(from_table(spark, d, "lineitem").select(F.col("l_shipdate").alias("day")), "day", train_range=60, test_range=1, shift=1, splits=2)
    preds = bt.backtest_models(feats, folds, "day", [], [bt.FitSpec("gbt", "gbt", {"maxIter": 20, "maxDepth": 6})],
                               label="revenue", exclude=["l_suppkey"], eval_days=None, parallelism=2)
    return bt.fold_scores(preds, ["model_label", "kind", "fold"], "revenue")


# ------------------------------------------------------------- reports as SQL text


def sql_null_profile(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A2 as SQL text."""
    cols = ["target", "datetime", "eic_count", "installed_capacity", "lowest_price_per_mwh",
            "highest_price_per_mwh", "euros_per_mwh"]
    return rsql.run_report(merged_hourly(spark, d), rsql.null_profile(cols))


def sql_series_completeness(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A3 as SQL text."""
    return rsql.run_report(read_events(spark, d), rsql.completeness("user_id, event_type", "value"))


def sql_avg_monthly_by_flag(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A4 as SQL text."""
    return rsql.run_report(_orders(spark, d), rsql.avg_monthly("o_orderdate", "o_totalprice", "is_final"))


def sql_growth_rate(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A5 as SQL text."""
    return rsql.run_report(_orders(spark, d), rsql.growth("o_orderdate", "o_totalprice"))


def sql_category_segment(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A6 as SQL text."""
    return _money(rsql.run_report(_orders(spark, d), rsql.category("c_mktsegment", "is_final", "o_totalprice")))


def sql_monthly_change(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A7/W1 as SQL text."""
    return _money(rsql.run_report(_orders(spark, d), rsql.monthly_change("o_orderdate", "o_totalprice", "is_final")))


def sql_top5_month(spark: SparkSession, d: str) -> DataFrame:
    """S8 + O2 as SQL text."""
    return _money(rsql.run_report(_orders(spark, d), rsql.top_groups(
        "c_nationkey, c_mktsegment", "o_orderdate", "o_totalprice", "1996-03-01 00:00:00", "1996-04-01 00:00:00", "is_final", 5)))


def sql_daily_moving_avg(spark: SparkSession, d: str) -> DataFrame:
    """S8 + A8/W2 as SQL text."""
    return _money(rsql.run_report(_orders(spark, d), rsql.moving_avg(
        "o_orderdate", "o_totalprice", "is_final AND c_mktsegment = 'BUILDING'", "1996-03-01", "1996-04-01")))


def sql_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """S8 + O1 as SQL text."""
    return rsql.run_report(merged_hourly(spark, d), rsql.first_rows("datetime, event_type, is_consumption, target, n, eic_count", 5))


def sql_merged(spark: SparkSession, d: str) -> DataFrame:
    """S8 + J1-J3: the merged table as SQL text (the transform's CTAS body)."""
    h = standins.hourly(spark, d).select("event_type", "datetime", "target", "is_consumption", "data_block_id")
    return rsql.run_merge(h, standins.daily_dim(spark, d), standins.daily_price(spark, d),
                          standins.hour_price(spark, d), unit="event_type")


def _dates_as_timestamps(fn: Query) -> Query:
    """Registered outputs carry calendar days as TIMESTAMP_NTZ (midnight).

    DATE values travel differently through the Spark and DuckDB clients;
    timestamps compare the same way in both. The library functions keep DATE.
    """
    def run(spark: SparkSession, d: str) -> DataFrame:
        df = fn(spark, d)
        dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
        if not dates:
            return df
        return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c) for c in df.columns])

    run.__doc__ = fn.__doc__
    run.__name__ = fn.__name__
    return run


_QUERIES: dict[str, Query] = {
    "merged_hourly": merged_hourly,
    "monthly_change": monthly_change,
    "lag_rolling_features": lag_rolling_features,
    "feature_table": feature_table,
    "capacity_fill": capacity_fill,
    "interpolate_gaps": interpolate_gaps,
    "clean_train": clean_train,
    "forecast_county": forecast_county,
    "forecast_dedup": forecast_dedup,
    "history_county": history_county,
    "weather_joined": weather_joined,
    "weather_forecast_joined": weather_forecast_joined,
    "weather_history_joined": weather_history_joined,
    "weather_joined_alt": weather_joined_alt,
    "forecast_county_union": forecast_county_union,
    "dedupe_readings": dedupe_readings,
    "null_profile": null_profile,
    "column_profile": column_profile,
    "first_rows": first_rows,
    "series_completeness": series_completeness,
    "avg_monthly_by_flag": avg_monthly_by_flag,
    "growth_rate": growth_rate,
    "category_segment": category_segment,
    "category_priority": category_priority,
    "category_nation": category_nation,
    "category_all": category_all,
    "top5_month": top5_month,
    "daily_moving_avg": daily_moving_avg,
    "holiday_pivot": holiday_pivot,
    "calendar_features": calendar_features,
    "calendar_years": calendar_years,
    "prediction_rows": prediction_rows,
    "best_lag": best_lag,
    "scalar_functions": scalar_functions,
    "yield_target": yield_target,
    "time_span": time_span,
    "value_counts": value_counts,
    "distinct_values": distinct_values,
    "range_filter": range_filter,
    "not_null_filter": not_null_filter,
    "drop_nulls": drop_nulls,
    "day_partition_roundtrip": day_partition_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "csv_flags_roundtrip": csv_flags_roundtrip,
    "negated_list": negated_list,
    "null_group_percentiles": null_group_percentiles,
    "fine_sums": fine_sums,
    "station_names": station_names,
    "declared_tables": declared_tables,
    "ddl_gas_prices": ddl_gas_prices,
    "ddl_clients": ddl_clients,
    "versioned_reload": versioned_reload,
    "holdout_remainder": holdout_remainder,
    "column_kinds": column_kinds,
    "linear_trend": linear_trend,
    "json_map_roundtrip": json_map_roundtrip,
    "semi_join_filter": semi_join_filter,
    "anti_join_filter": anti_join_filter,
    "train_window": train_window,
    "duplicate_line_keys": duplicate_line_keys,
    "top_bottom_items": top_bottom_items,
    "cast_and_fill": cast_and_fill,
    "month_folds": month_folds,
    "share_folds": share_folds,
    "fold_membership": fold_membership,
    "eval_holdout": eval_holdout,
    "naive_scores": naive_scores,
    "naive_scores_sliced": naive_scores_sliced,
    "sketched_percentiles": sketched_percentiles,
    "clustered_range": clustered_range,
    "mae_ratio": mae_ratio,
    "error_percentiles": error_percentiles,
    "residuals_by_hour": residuals_by_hour,
    "residuals_weekly": residuals_weekly,
    "score_compare": score_compare,
    "gbt_backtest": gbt_backtest,
    "objective_comparison": objective_comparison,
    "param_search": param_search,
    "best_model_holdout": best_model_holdout,
    "gain_summary": gain_summary,
    "sliding_median": sliding_median,
    "boosted_tree": boosted_tree,
    "boosted_gains": boosted_gains,
    "stopping_rounds": stopping_rounds,
    "halving_rungs": halving_rungs,
    "boost_backtest": boost_backtest,
    "supplier_daily_features": supplier_daily_features,
    "sql_null_profile": sql_null_profile,
    "sql_series_completeness": sql_series_completeness,
    "sql_avg_monthly_by_flag": sql_avg_monthly_by_flag,
    "sql_growth_rate": sql_growth_rate,
    "sql_category_segment": sql_category_segment,
    "sql_monthly_change": sql_monthly_change,
    "sql_top5_month": sql_top5_month,
    "sql_daily_moving_avg": sql_daily_moving_avg,
    "sql_first_rows": sql_first_rows,
    "sql_merged": sql_merged,
    "supplier_gbt_backtest": supplier_gbt_backtest,
    "yield_backtest": yield_backtest,
}

QUERIES: dict[str, Query] = {k: _dates_as_timestamps(v) for k, v in _QUERIES.items()}
