"""SQL-style reports over the merged hourly table.

Each report is a function of column names, returning a lazy DataFrame. Sums
are sums of doubles; where a report rounds a result, it rounds half-up through
DECIMAL, as the SQL originals do with ``::numeric``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.scalar import trunc_ts
from hourgrid.operators.aggregate import null_counts, rounded, top_k, total
from hourgrid.operators.timeseries import moving_average, period_over_period

__all__ = [
    "first_rows",
    "null_report",
    "series_completeness",
    "avg_monthly_total",
    "growth_rate",
    "category_summary",
    "category_summaries",
    "monthly_change",
    "top_groups_in_period",
    "daily_moving_averages",
]


def first_rows(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """``ORDER BY cols LIMIT n`` (O1); ascending with nulls last, as SQL does."""
    return top_k(df, [F.col(c).asc_nulls_last() for c in order_cols], n)


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of NULL counts (A2)."""
    return null_counts(df, cols)


def series_completeness(df: DataFrame, series_cols: Sequence[str], value_col: str) -> DataFrame:
    """Non-null values per series, summarised: count/min/avg/median/max (A3).

    The median is the discrete one (a value that occurs), like
    ``PERCENTILE_DISC(0.5)``. Series are counted by their number of entries
    first; everything else is read off that small histogram.
    """
    per = df.groupBy(*series_cols).agg(F.count(value_col).cast("long").alias("number_of_entries"))
    n, c = F.col("number_of_entries"), F.col("_series")
    # one row per distinct count of entries: the windows below see only these
    hist = per.groupBy(n).agg(F.count(F.lit(1)).alias("_series"))
    upto = F.sum(c).over(Window.orderBy(n).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = F.sum(c).over(Window.partitionBy())
    hist = hist.select(n, c, F.when(2 * upto >= every, n).alias("_upper"))
    return hist.agg(
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("number_of_timeseries"), F.min(n).alias("min_entries"),
        rounded(F.try_divide(F.sum(n * c), F.sum(c)), 2).alias("avg_entries"), F.min("_upper").alias("median_entries"), F.max(n).alias("max_entries"),
    )


def avg_monthly_total(df: DataFrame, time_col: str, value_col: str, flag_col: str,
                      scale: float = 1_000_000.0, name: str = "avg_monthly_target_GWh") -> DataFrame:
    """Average over months of the monthly total, per flag, rounded, scaled (A4)."""
    monthly = df.groupBy(trunc_ts("month", time_col).alias("month"), flag_col).agg(
        total(value_col).alias("sum_target")
    )
    return monthly.groupBy(flag_col).agg((rounded(F.avg("sum_target"), 2) / scale).alias(name))


def growth_rate(df: DataFrame, time_col: str, value_col: str, name: str = "capacity_CAGR") -> DataFrame:
    """Compound annual growth between the first and last timestamp with a value.

    The source attaches global bounds with a cross join. Here one aggregate by
    timestamp (partial/final) is followed by a global aggregate over the
    distinct timestamps that picks the first and last totals with
    ``min_by``/``max_by``: no join at all.
    """
    per_ts = df.filter(F.col(value_col).isNotNull()).groupBy(time_col).agg(total(value_col).alias("_v"))
    t = F.col(time_col)
    b = per_ts.agg(
        F.min(t).alias("first_dt"), F.max(t).alias("last_dt"),
        F.min_by("_v", t).alias("first_val"), F.max_by("_v", t).alias("last_val"),
    )
    years = F.timestamp_diff("MICROSECOND", F.col("first_dt"), F.col("last_dt")) / 1e6 / 86400.0 / 365.25
    cagr = (F.pow(F.try_divide(F.col("last_val"), F.col("first_val")), F.lit(1.0) / years) - 1.0) * 100.0
    return b.select(rounded(cagr, 2).alias(name))


def category_summary(df: DataFrame, category: str, flag_col: str, value_col: str) -> DataFrame:
    """Average (rounded) and total of the value per (category, flag)."""
    return df.groupBy(category, flag_col).agg(
        rounded(F.avg(value_col), 2).alias("avg_hourly_target"), total(value_col).alias("total_target")
    ).orderBy(F.col(flag_col).asc_nulls_last(), F.col("avg_hourly_target").desc_nulls_first())


def category_summaries(df: DataFrame, categories: Sequence[str], flag_col: str, value_col: str) -> DataFrame:
    """All category summaries from ONE grouping-sets aggregate (A6, one scan).

    Output: (category_name, category_value as string, flag, avg, total).
    """
    sets = [[c, flag_col] for c in categories]
    g = df.groupingSets(sets, *categories, flag_col).agg(
        rounded(F.avg(value_col), 2).alias("avg_hourly_target"), total(value_col).alias("total_target"),
        *[F.grouping(c).alias(f"_g_{c}") for c in categories],
    )
    name = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for c in categories:
        hit = F.col(f"_g_{c}") == 0
        name = F.when(hit, F.lit(c)).otherwise(name)
        val = F.when(hit, F.col(c).cast("string")).otherwise(val)
    return g.select(name.alias("category"), val.alias("category_value"), flag_col, "avg_hourly_target",
                    "total_target")


def monthly_change(df: DataFrame, time_col: str, value_col: str, predicate: Column | None = None,
                   name: str = "consumption") -> DataFrame:
    """Monthly total and month-over-month difference / %."""
    src = df.filter(predicate) if predicate is not None else df
    m = src.groupBy(trunc_ts("month", time_col).alias("month")).agg(total(value_col).alias(name))
    out = period_over_period(m, "month", name, prefix="MoM")
    return out.withColumn("MoM_diff_pct", rounded("MoM_diff_pct", 2))


def top_groups_in_period(df: DataFrame, group_cols: Sequence[str], time_col: str, value_col: str,
                         start: str, end: str, predicate: Column | None = None, n: int = 5,
                         name: str = "consumption") -> DataFrame:
    """Top-n groups by total in ``[start, end)`` (O2, P9); ties broken by the keys."""
    cond = (F.col(time_col) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time_col) < F.lit(end).cast("timestamp_ntz"))
    if predicate is not None:
        cond = cond & predicate
    g = df.filter(cond).groupBy(*group_cols).agg(total(value_col).alias(name))
    return top_k(g, [F.col(name).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in group_cols]], n)


def daily_moving_averages(df: DataFrame, time_col: str, value_col: str, start: str, end: str,
                          predicate: Column | None = None, sizes: Sequence[int] = (3, 7),
                          name: str = "consumption") -> DataFrame:
    """Daily totals, 3/7-row trailing means, then the date filter.

    The filter is applied after the window on purpose: the first days of the
    period average over days before it.
    """
    src = df.filter(predicate) if predicate is not None else df
    d = src.groupBy(F.to_date(time_col).alias("date")).agg(total(value_col).alias(name))
    out = moving_average(d, "date", name, sizes, name="{value}_MA_{n}d")
    return out.filter((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
