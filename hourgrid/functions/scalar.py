"""Scalar column expressions: time arithmetic, unit conversions, ratios.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "epoch_us",
    "shift_time",
    "shift_months",
    "hours_to_interval",
    "trunc_ts",
    "to_day",
    "grid_key",
    "m_to_mm",
    "zero_below",
    "wind_speed",
    "wind_u",
    "wind_v",
    "clip_lower",
    "snow_cm_to_mm",
    "safe_ratio",
    "yield_of",
    "from_yield",
    "abs_error",
    "round_half_even",
    "round_half_up",
    "elapsed_seconds",
    "parse_duration_us",
    "US_PER",
]

# Microseconds per duration unit (fixed values of the duration grammar).
US_PER = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "min": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
    "W": 7 * 86_400_000_000,
}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_duration_us(text: str) -> int:
    """Parse a fixed duration such as ``"48h"``, ``"7d"``, ``"2d"``, ``"3W"``.

    Months/years are calendar-dependent and are rejected here; use
    :func:`shift_months` for them.
    """
    s = text.strip()
    num = ""
    while s and (s[0].isdigit() or s[0] == "."):
        num, s = num + s[0], s[1:]
    unit = s.strip() or "d"
    if unit not in US_PER or not num:
        raise ValueError(f"unsupported duration {text!r}")
    return int(round(float(num) * US_PER[unit]))


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_us(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (time-zone free).

    RANGE window frames need a numeric order key; ``unix_micros`` only takes
    LTZ timestamps, so the difference to the NTZ epoch is used instead.
    """
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col_of(c))


def shift_time(c: str | Column, duration: str | int) -> Column:
    """``ts + duration`` as wall-clock arithmetic on TIMESTAMP_NTZ (F1).

    ``duration`` is a string such as ``"2d"``/``"-48h"`` or microseconds.
    """
    us = duration if isinstance(duration, int) else _signed_us(duration)
    return F.timestamp_add("MICROSECOND", F.lit(us), col_of(c))


def _signed_us(text: str) -> int:
    t = text.strip()
    if t.startswith("-"):
        return -parse_duration_us(t[1:])
    return parse_duration_us(t.lstrip("+"))


def shift_months(c: str | Column, months: int | Column) -> Column:
    """Calendar month shift that keeps the time of day and clamps to month end."""
    m = months if isinstance(months, Column) else F.lit(months)
    return F.timestamp_add("MONTH", m, col_of(c))


def hours_to_interval(c: str | Column) -> Column:
    """Integer hours → day-time interval."""
    return F.make_dt_interval(F.lit(0), col_of(c).cast("int"))


def trunc_ts(unit: str, c: str | Column) -> Column:
    """Truncate a wall-clock TIMESTAMP_NTZ to hour/day/month/year (F2).

    Built from its calendar fields with ``make_timestamp_ntz``, so the result
    never depends on the session time zone (``date_trunc`` would go through
    a zoned timestamp and can shift at DST switches). Other units fall back
    to ``date_trunc``.
    """
    t = col_of(c)
    zero = F.lit(0)
    u = unit.lower()
    if u == "hour":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), zero, zero)
    if u == "day":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), zero, zero, zero)
    if u == "month":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.lit(1), zero, zero, zero)
    if u == "year":
        return F.make_timestamp_ntz(F.year(t), F.lit(1), F.lit(1), zero, zero, zero)
    return F.date_trunc(unit, t).cast("timestamp_ntz")


def to_day(c: str | Column) -> Column:
    """Calendar date of a timestamp (F2)."""
    return F.to_date(col_of(c))


def grid_key(c: str | Column) -> Column:
    """Latitude/longitude → integer grid key: round to 0.1°, times 10."""
    return F.round(col_of(c) * 10).cast("int")


def m_to_mm(c: str | Column) -> Column:
    """Metres → millimetres."""
    return col_of(c) * 1000.0


def zero_below(c: str | Column, threshold: float = 0.1) -> Column:
    """Set values with ``abs(x) < threshold`` to 0.

    A null value also becomes 0, as in the pandas ``where`` it replaces.
    """
    x = col_of(c)
    return F.when(F.abs(x) >= threshold, x).otherwise(F.lit(0.0))


def wind_speed(u: str | Column, v: str | Column) -> Column:
    """Wind speed from components (F8)."""
    return F.sqrt(col_of(u) * col_of(u) + col_of(v) * col_of(v))


def wind_u(speed: str | Column, direction_deg: str | Column) -> Column:
    """Eastward component from speed and direction in degrees."""
    return -col_of(speed) * F.sin(F.radians(col_of(direction_deg)))


def wind_v(speed: str | Column, direction_deg: str | Column) -> Column:
    """Northward component from speed and direction in degrees."""
    return -col_of(speed) * F.cos(F.radians(col_of(direction_deg)))


def clip_lower(c: str | Column, lower: float) -> Column:
    """Lower clip that keeps nulls."""
    x = col_of(c)
    return F.when(x < lower, F.lit(lower)).otherwise(x)


def snow_cm_to_mm(c: str | Column, density_ratio: float = 0.1) -> Column:
    """Snow depth in cm → water equivalent in mm."""
    return col_of(c) * 10.0 * density_ratio


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with NULL for a zero or null denominator."""
    return F.try_divide(col_of(num), col_of(den))


def yield_of(target: str | Column, capacity: str | Column, is_consumption: str | Column,
             floor: float = 1.0) -> Column:
    """Production yield = target / max(capacity, floor); NULL on consumption rows."""
    cap = clip_lower(capacity, floor)
    return F.when(~col_of(is_consumption), col_of(target) / cap)


def from_yield(y: str | Column, capacity: str | Column, floor: float = 1.0) -> Column:
    """Inverse of :func:`yield_of` (capacity clipped the same way)."""
    return col_of(y) * clip_lower(capacity, floor)


def abs_error(y: str | Column, p: str | Column) -> Column:
    """Absolute error (F16)."""
    return F.abs(col_of(y) - col_of(p))


def round_half_even(c: str | Column, scale: int = 0) -> Column:
    """Banker's rounding, as pandas ``round``."""
    return F.bround(col_of(c), scale)


def round_half_up(c: str | Column, scale: int = 0) -> Column:
    """Half-away-from-zero rounding, as SQL ``ROUND(numeric)``."""
    return F.round(col_of(c), scale)


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Seconds between two timestamps as DOUBLE."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end)) / 1e6


TWO_PI = 2.0 * math.pi
