"""Projection, typing, filtering and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions.scalar import epoch_us
from hourgrid.operators.timeseries import interpolate_segment, keep_first

__all__ = [
    "project",
    "cast_columns",
    "drop_null_rows",
    "fill_constants",
    "rename",
    "drop_columns",
    "between",
    "half_open",
    "not_null",
    "semi_filter",
    "columns_of_type",
    "categorical_columns",
    "dedupe_on_keys",
    "split_features_target",
    "clean_series_nulls",
]


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep only ``cols`` (P1). Catalyst prunes the scan to them."""
    return df.select(*cols)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast listed columns to declared types (P2); ``safe`` uses ``try_cast``."""
    def conv(c: str) -> Column:
        if c not in types:
            return F.col(c)
        return (F.col(c).try_cast(types[c]) if safe else F.col(c).cast(types[c])).alias(c)
    return df.select(*[conv(c) for c in df.columns])


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (and NaN) in ``subset``."""
    cols = list(subset) if subset is not None else df.columns
    out = df.na.drop("any", subset=cols)
    fl = [c for c in cols if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    for c in fl:
        out = out.filter(~F.isnan(F.col(c)))
    return out


def fill_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Constant NULL fill per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (P5)."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop listed columns (P7); unknown names are ignored."""
    return df.drop(*cols)


def between(df: DataFrame, col: str, lo: Any, hi: Any, **equal: Any) -> DataFrame:
    """Inclusive range filter plus optional equality filters."""
    cond = F.col(col).between(F.lit(lo), F.lit(hi))
    for c, v in equal.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def half_open(df: DataFrame, col: str, lo: Any, hi: Any, predicate: Column | None = None) -> DataFrame:
    """``lo <= col < hi`` plus an optional boolean predicate."""
    cond = (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi))
    if predicate is not None:
        cond = cond & predicate
    return df.filter(cond)


def not_null(df: DataFrame, col: str) -> DataFrame:
    """``col IS NOT NULL`` (P10)."""
    return df.filter(F.col(col).isNotNull())


def semi_filter(df: DataFrame, keys: DataFrame | Sequence[Any], on: str | Sequence[str],
                negate: bool = False) -> DataFrame:
    """Membership filter.

    With a literal list it is ``isin``; with a DataFrame of keys it is a
    ``left_semi``/``left_anti`` join. A NULL is in neither, so the negated
    filter keeps it in both forms.
    """
    if isinstance(keys, DataFrame):
        on_cols = [on] if isinstance(on, str) else list(on)
        return df.join(keys.select(*on_cols).distinct(), on_cols,
                       "left_anti" if negate else "left_semi")
    cond = F.coalesce(F.col(on).isin(list(keys)), F.lit(False))
    return df.filter(~cond if negate else cond)


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    """Column names whose Spark type is one of ``types``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def categorical_columns(df: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """Boolean and string columns plus ``extra`` integer code columns."""
    cats = columns_of_type(df, T.BooleanType, T.StringType)
    return cats + [c for c in extra if c not in cats]


def dedupe_on_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact duplicate removal on ``keys``.

    The surviving copy is the smallest by all other columns (ascending), a
    deterministic choice under any partitioning.
    """
    return keep_first(df, keys)


def split_features_target(df: DataFrame, time_col: str, start: Any, end: Any, target_col: str = "target",
                          to_drop: Sequence[str] = ()) -> DataFrame:
    """Rows with ``start <= time <= end``, minus ``to_drop``.

    Features and target stay in one DataFrame; the learner reads the target
    column by name, so no second pass over the data is needed.
    """
    return df.filter(F.col(time_col).between(F.lit(start), F.lit(end))).drop(*to_drop)


def clean_series_nulls(
    df: DataFrame,
    time_col: str,
    value_col: str,
    group_cols: Sequence[str],
    check_cols: Sequence[str] | None = None,
    bucket_days: int = 28,
) -> DataFrame:
    """Alternate train cleaning.

    The distinct timestamps that carry a NULL (in ``check_cols``) are numbered
    in time order; every second one (the missing spring hour of a DST pair) is
    removed, then the remaining NULL targets are interpolated inside each
    series (W6). Timestamps are numbered within buckets of ``bucket_days`` and
    shifted by the counts of the buckets before, so data of any resolution is
    numbered in many tasks. A row without a time is never removed.
    """
    cols = list(check_cols) if check_cols is not None else df.columns
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    bad = df.filter(any_null & F.col(time_col).isNotNull()).select(time_col).distinct()
    bad = bad.withColumn("_b", F.floor(epoch_us(time_col) / F.lit(bucket_days * 86_400_000_000)))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket of days
    starts = bad.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(time_col))
    ranked = bad.withColumn("_k", inside).join(starts, "_b")
    drop_ts = ranked.filter((F.col("_off") + F.col("_k")) % 2 == 0).select(time_col)
    kept = df.join(drop_ts, [time_col], "left_anti")
    return interpolate_segment(kept, value_col, time_col, group_cols)
