"""Calendar features: parts of the timestamp, DST flag, cyclic encodings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.scalar import col_of

__all__ = [
    "DST_SWITCHES",
    "CYCLIC_PERIODS",
    "dst_flag",
    "add_calendar_features",
    "add_cyclic_features",
]

# Local DST switch instants covered by the source data
# (summer time ends / starts at 03:00 wall-clock).
DST_SWITCHES = (
    "2021-10-31 03:00:00",
    "2022-03-27 03:00:00",
    "2022-10-30 03:00:00",
    "2023-03-26 03:00:00",
)

# Periods of the cyclic encodings.
CYCLIC_PERIODS = (
    ("hour", 24.0),
    ("day_of_week", 7.0),
    ("day_of_month", 30.4),
    ("month", 12.0),
    ("day_of_year", 365.0),
    ("week_of_year", 52.0),
    ("quarter", 4.0),
)


def dst_flag(c: str | Column, switches: Sequence[str] = DST_SWITCHES,
             summer_first: bool = True) -> Column:
    """True when ``c`` lies in summer time.

    ``switches`` are the sorted switch instants; with ``summer_first`` the span
    before the first switch is summer time and the state flips at each one.
    Everything is evaluated as one boolean expression per row.
    """
    ts = col_of(c)
    bounds = [F.lit(s).cast("timestamp_ntz") for s in switches]
    spans = []
    edges = [None, *bounds, None]
    summer = summer_first
    for lo, hi in zip(edges[:-1], edges[1:]):
        if summer:
            cond = F.lit(True)
            if lo is not None:
                cond = cond & (ts >= lo)
            if hi is not None:
                cond = cond & (ts < hi)
            spans.append(cond)
        summer = not summer
    out = spans[0]
    for s in spans[1:]:
        out = out | s
    return out


def add_calendar_features(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Hour, weekday (Monday = 0), month, quarter, day of month/year, ISO week."""
    if time_col not in df.columns:
        raise KeyError(f"no time column named {time_col!r}")
    t = F.col(time_col)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": F.weekday(t),
            "month": F.month(t),
            "quarter": F.quarter(t),
            "day_of_month": F.dayofmonth(t),
            "day_of_year": F.dayofyear(t),
            "week_of_year": F.weekofyear(t),
        }
    )


def add_cyclic_features(df: DataFrame, time_col: str = "datetime",
                        drop_raw: bool = True) -> DataFrame:
    """sin/cos encodings of the calendar parts (F5), as FLOAT."""
    out = add_calendar_features(df, time_col)
    enc = {}
    for name, period in CYCLIC_PERIODS:
        angle = F.lit(2.0 * math.pi) * F.col(name) / F.lit(period)
        enc[f"{name}_sin"] = F.sin(angle).cast("float")
        enc[f"{name}_cos"] = F.cos(angle).cast("float")
    out = out.withColumns(enc)
    if drop_raw:
        out = out.drop(*[n for n, _ in CYCLIC_PERIODS])
    return out
