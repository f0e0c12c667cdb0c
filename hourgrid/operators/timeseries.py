"""Time-series operators on long-format series.

A series is identified by ``group_cols`` and ordered by ``time_col``
(TIMESTAMP_NTZ). All operators are window/aggregate compositions; none moves a
whole series into one task:

* exact time lags and time-range rollings run in windows partitioned by
  (series, time bucket). Each row is copied into the later buckets it can
  influence (the *halo*), so a hot series is split over many tasks and all lag
  and rolling specs share one exchange and one sort;
* fills and interpolation use a two-level scan: a window inside each
  (series, bucket) plus a small per-bucket summary that carries the last/next
  valid value and the row counts across buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions.scalar import epoch_us, parse_duration_us
from hourgrid.operators.joins import check_unique
from hourgrid.session import materialize

__all__ = [
    "ROLLING_FUNCS",
    "lag_name",
    "rolling_name",
    "add_lags",
    "add_rollings",
    "add_lags_and_rollings",
    "add_sliding_median",
    "fill_segment",
    "interpolate_segment",
    "keep_last",
    "keep_first",
    "period_over_period",
    "moving_average",
    "auto_bucket_us",
]

_T = "_t_us"
_BK = "_bk"
_HOME = "_home"

DAY_US = 86_400_000_000
#: Lags beyond this many days are copied to their instant, not reached by a window.
LONG_LAG_DAYS = 28


def lag_name(value_col: str, lag: str) -> str:
    return f"{value_col}_lag_{lag}"


def rolling_name(value_col: str, window: str, func: str) -> str:
    return f"{value_col}_{window}_win_{func}"


def _rolling_expr(func: str, x: Column, frame) -> Column:
    if func == "mean":
        return F.avg(x).over(frame)
    if func == "std":
        return F.stddev_samp(x).over(frame)
    if func == "median":
        return F.percentile(x, F.lit(0.5)).over(frame)
    if func == "count":
        # no row in the frame -> NULL, rows but all null -> 0 (pandas rules)
        # DOUBLE like the pandas result (NULL-able counts)
        return F.when(F.count(F.lit(1)).over(frame) > 0, F.count(x).over(frame).cast("double"))
    if func == "sum":
        return F.when(F.count(x).over(frame) > 0, F.sum(x).over(frame))
    if func == "min":
        return F.min(x).over(frame)
    if func == "max":
        return F.max(x).over(frame)
    if func == "var":
        return F.var_samp(x).over(frame)
    raise ValueError(f"unknown rolling function {func!r}")


ROLLING_FUNCS = ("mean", "std", "median", "count", "sum", "min", "max", "var")


def auto_bucket_us(halo_us: int, min_days: int = 7) -> int:
    """Bucket length for halo windows: 4x the halo, at least ``min_days``.

    Replication of rows is ``1 + halo / bucket`` (<= 1.25 here).
    """
    return max(4 * halo_us, min_days * DAY_US)


def _with_buckets(df: DataFrame, halo_us: int, bucket_us: int) -> DataFrame:
    """Copy each row into its own bucket and the later buckets within ``halo``."""
    t = F.col(_T)
    home = F.floor(t / F.lit(bucket_us))
    last = F.floor((t + F.lit(halo_us)) / F.lit(bucket_us))
    # outer and null-safe: a row without a time has no bucket to go to and stays as it is
    return df.withColumn(_BK, F.explode_outer(F.sequence(home, last))).withColumn(_HOME, F.col(_BK).eqNullSafe(home))


def add_lags_and_rollings(
    df: DataFrame,
    value_col: str,
    lag_specs: Mapping[str, Mapping[str, Sequence[str]] | None],
    time_col: str,
    group_cols: Sequence[str],
    bucket: str | int | None = "auto",
    dtype: str | None = "float",
    validate: bool = False,
) -> DataFrame:
    """Exact time lags of ``value_col`` and time-range rollings over them.

    ``lag_specs`` maps a lag (``"2d"``, ``"49h"``) to ``{window: [funcs]}`` or
    None. Lag ``L`` is the value at exactly ``t - L`` in the same series (NULL
    if that instant is absent). Rolling ``w`` over the lag column uses rows in
    ``[t - w, t)``. Names follow ``{value}_lag_{L}`` and
    ``{value}_lag_{L}_{w}_win_{func}``; rollings are cast to ``dtype``.

    ``bucket``: "auto" (halo-bucketed windows), microseconds, or None for one
    window partition per series. The result is the same; only the physical
    layout differs. A lag longer than ``LONG_LAG_DAYS`` does not widen the halo:
    its values are copied to the instant at which they are due, and the windows
    reach back only as far as the rollings do.
    """
    if validate:
        check_unique(df, [*group_cols, time_col], "series")
    cols = list(df.columns)
    specs = {lag: (dict(w) if w else {}) for lag, w in lag_specs.items()}
    lag_us = {lag: parse_duration_us(lag) for lag in specs}
    win_us = {(lag, w): parse_duration_us(w) for lag, ws in specs.items() for w in ws}
    far = [lag for lag in specs if bucket is not None and lag_us[lag] > LONG_LAG_DAYS * DAY_US]
    halo = max([(0 if lag in far else lag_us[lag]) + win_us.get((lag, w), 0) for lag, ws in specs.items() for w in (ws or [None])] or [0])

    out = df.withColumn(_T, epoch_us(time_col))
    if far:
        out = _due_values(out, value_col, {lag_name(value_col, lag): lag_us[lag] for lag in far}, list(group_cols))
    parts = list(group_cols)
    if bucket is not None and halo > 0:
        b = auto_bucket_us(halo) if bucket == "auto" else int(bucket)
        out = _with_buckets(out, halo, b)
        parts = [*parts, _BK]
    base = Window.partitionBy(*parts).orderBy(_T)
    x = F.col(value_col)

    # rows without a time are peers of each other in a RANGE frame: they have no past
    timed = F.col(_T).isNotNull()
    lag_cols = {lag_name(value_col, lag): F.when(timed, F.max(x).over(base.rangeBetween(-lag_us[lag], -lag_us[lag]))) for lag in specs if lag not in far}
    if lag_cols:
        out = out.withColumns(lag_cols)

    roll_cols = {}
    for lag, ws in specs.items():
        src = lag_name(value_col, lag)
        for w, funcs in ws.items():
            frame = base.rangeBetween(-win_us[(lag, w)], -1)
            for func in funcs:
                e = F.when(timed, _rolling_expr(func, F.col(src), frame))
                roll_cols[rolling_name(src, w, func)] = e.cast(dtype) if dtype else e
    if roll_cols:
        out = out.withColumns(roll_cols)
    if _HOME in out.columns:
        out = out.filter(F.col(_HOME))
    new = [*(lag_name(value_col, lag) for lag in specs), *roll_cols]
    return out.select(*cols, *new)


def _due_values(df: DataFrame, value_col: str, due_us: Mapping[str, int], group_cols: list[str]) -> DataFrame:
    """Add the value due at each row's instant, per named lag: rows and narrow copies meet by (series, instant)."""
    cols = list(df.columns)
    empty = F.lit(None).cast(df.schema[value_col].dataType)
    row = F.struct(*cols)
    own = F.struct(F.col(_T).alias("at"), row.alias("row"), empty.alias("due"), F.lit(-1).alias("kind"))
    copies = [F.struct((F.col(_T) + F.lit(us)).alias("at"), F.when(F.lit(False), row).alias("row"), F.col(value_col).alias("due"), F.lit(i).alias("kind"))
              for i, us in enumerate(due_us.values())]
    # a row without a time is due nowhere
    sent = F.when(F.col(_T).isNotNull(), F.array(own, *copies)).otherwise(F.array(own))
    met = df.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(group_cols)], F.explode(sent).alias("_m")).select(
        *[f"_s{i}" for i in range(len(group_cols))], "_m.*")
    w = Window.partitionBy(*[f"_s{i}" for i in range(len(group_cols))], "at")
    lagged = met.withColumns({name: F.max(F.when(F.col("kind") == i, F.col("due"))).over(w) for i, name in enumerate(due_us)})
    return lagged.filter(F.col("kind") == -1).select(*[F.col("row")[c].alias(c) for c in cols], *due_us)


def add_lags(df: DataFrame, value_col: str, lags: Sequence[str], time_col: str,
             group_cols: Sequence[str], bucket: str | int | None = "auto") -> DataFrame:
    """Exact time lags only."""
    return add_lags_and_rollings(df, value_col, {lag: None for lag in lags}, time_col, group_cols,
                                 bucket=bucket, dtype=None)


def add_rollings(
    df: DataFrame,
    value_col: str,
    windows: Mapping[str, Sequence[str]],
    time_col: str,
    group_cols: Sequence[str],
    bucket: str | int | None = "auto",
    dtype: str | None = "float",
) -> DataFrame:
    """Time-range rollings ``[t - w, t)`` of ``value_col`` itself."""
    cols = list(df.columns)
    halo = max(parse_duration_us(w) for w in windows)
    out = df.withColumn(_T, epoch_us(time_col))
    parts = list(group_cols)
    if bucket is not None:
        b = auto_bucket_us(halo) if bucket == "auto" else int(bucket)
        out = _with_buckets(out, halo, b)
        parts = [*parts, _BK]
    base = Window.partitionBy(*parts).orderBy(_T)
    new = {}
    for w, funcs in windows.items():
        frame = base.rangeBetween(-parse_duration_us(w), -1)
        for func in funcs:
            e = F.when(F.col(_T).isNotNull(), _rolling_expr(func, F.col(value_col), frame))
            new[rolling_name(value_col, w, func)] = e.cast(dtype) if dtype else e
    out = out.withColumns(new)
    if _HOME in out.columns:
        out = out.filter(F.col(_HOME))
    return out.select(*cols, *new)


def add_sliding_median(df: DataFrame, value_col: str, window: str, time_col: str, group_cols: Sequence[str], bins: int = 32,
                       bucket: str | int | None = "auto", dtype: str | None = "float") -> DataFrame:
    """The exact rolling median of ``[t - w, t)`` without sorting every frame (W3); named like :func:`add_rollings` names it.

    1. Values fall into ``bins`` ranges of about equal numbers of rows (their bounds only balance the work).
    2. Per row, running counts of each range up to t and up to t - w: their differences are the histogram of the
       row's frame, and tell the ranges that hold its middle ranks.
    3. In such a range alone, the values of the frame are sorted, about 1 / ``bins`` of them.

    A row costs ``bins`` counters and 1 / ``bins`` of its frame, where ``percentile`` over the frame costs all of
    it. Rows are copied into the time buckets that they reach, as for the other rollings, so a long
    series is many tasks; they are exchanged and sorted once, and tasks count a batch of rows at a time, holding
    but the frames that later rows reach back to. NULL and NaN values are left out; a frame without values gives NULL.
    """
    cols, w = list(df.columns), parse_duration_us(window)
    name, keys = rolling_name(value_col, window, "median"), [f"_s{i}" for i in range(len(group_cols))]
    x = F.col(value_col).cast("double")
    rows = materialize(df.select(F.struct(*cols).alias("_all"), *[F.col(c).alias(k) for c, k in zip(group_cols, keys)], epoch_us(time_col).alias(_T),
                                 F.when(~F.isnan(x), x).alias("_x")), "median-rows")
    cuts = rows.agg(F.percentile_approx("_x", F.array(*[F.lit(i / bins) for i in range(1, bins)]), 10000).alias("c")).first()["c"]
    timed, parts = rows.filter(F.col(_T).isNotNull()).withColumn(_HOME, F.lit(True)), list(keys)
    if bucket is not None:
        timed = _with_buckets(timed, w, auto_bucket_us(w) if bucket == "auto" else int(bucket))
        parts = [*parts, _BK]
    # a series starts at position 1; the window leaves its rows in order
    place = F.row_number().over(Window.partitionBy(*parts).orderBy(_T))
    ordered = timed.select(place.alias("_place"), _HOME, F.when(F.col(_HOME), F.col("_all")).alias("_all"), _T, "_x")
    schema = T.StructType([T.StructField("_all", rows.schema["_all"].dataType), T.StructField("_median", T.DoubleType())])
    found = ordered.mapInArrow(_median_task(sorted(set(cuts or [])), w), schema)
    out = found.unionByName(rows.filter(F.col(_T).isNull()).select("_all", F.lit(None).cast("double").alias("_median")))
    return out.select(*[F.col("_all")[c].alias(c) for c in cols], F.col("_median").cast(dtype or "double").alias(name))


def _median_task(edges: Sequence[float], w: int):
    """Task of :func:`add_sliding_median`: from ordered rows to the home rows with their medians."""

    def medians(group, at, values, asked_group, asked):
        # frames as ranges of the rows with a value, which are in order of (series, time)
        times = np.unique(at)
        key = group * (len(times) + 1) + np.searchsorted(times, at)
        lo, hi = (np.searchsorted(key, asked_group * (len(times) + 1) + np.searchsorted(times, t)) for t in (asked - w, asked))
        n, bin_ = hi - lo, np.searchsorted(np.array(edges, dtype=np.float64), values)
        ranks, before = ((n - 1) // 2, n // 2), np.zeros(len(n), dtype=np.int64)
        middle = [np.full(len(n), np.nan) for _ in ranks]
        for k in range(len(edges) + 1):
            upto = np.concatenate([[0], np.cumsum(bin_ == k)])
            first, held = upto[lo], upto[hi] - upto[lo]
            inside = values[bin_ == k]
            for rank, out in zip(ranks, middle):
                hit = np.nonzero((rank >= before) & (rank < before + held))[0]
                out[hit] = _ranked(inside, first[hit], held[hit], rank[hit] - before[hit])
            before += held
        # adding zero turns -0.0 into 0.0, as a sum does
        return np.where(n % 2 == 1, middle[0] + 0.0, (middle[0] + middle[1] + 0.0) / 2), n > 0

    def run(batches):
        held = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        waiting, last = [], 0

        def answer():
            nonlocal held, last
            place, t = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in waiting]) for c in ("_place", _T))
            x = np.concatenate([b.column("_x").to_numpy(zero_copy_only=False).astype(np.float64) for b in waiting])
            home = np.concatenate([b.column(_HOME).to_numpy(zero_copy_only=False) for b in waiting]).astype(bool)
            group, has = last + np.cumsum(place == 1), ~np.isnan(x)
            last = group[-1]
            rows = [np.concatenate([a, b[has]]) for a, b in zip(held, (group, t, x))]
            got, some = medians(*rows, group[home], t[home])
            reach = (rows[0] == last) & (rows[1] >= t[-1] - w)
            held, start = tuple(r[reach] for r in rows), 0
            out = pa.array(got, pa.float64(), mask=~some)
            for b in waiting:
                own = b.column("_all").filter(b.column(_HOME))
                yield pa.RecordBatch.from_arrays([own, out.slice(start, len(own))], names=["_all", "_median"])
                start += len(own)
            waiting.clear()

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) > len(held[0]):
                yield from answer()
        if waiting:
            yield from answer()

    return run


def _ranked(values: np.ndarray, first: np.ndarray, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Per row the value of a rank (from 0) among ``size`` values from ``first`` on; rows of like sizes are sorted together."""
    out, width = np.empty(len(first)), 1
    todo = np.argsort(size, kind="stable")
    while len(todo):
        now, todo = np.split(todo, [np.searchsorted(size[todo], width, side="right")])
        step, offset = max(1, (1 << 20) // width), np.arange(width)
        for i in range(0, len(now), step):
            part = now[i:i + step]
            cells = values[np.minimum(first[part, None] + offset, len(values) - 1)]
            cells[offset >= size[part, None]] = np.inf
            cells.sort(axis=1)
            out[part] = cells[np.arange(len(part)), rank[part]]
        width *= 2
    return out


# ---------------------------------------------------------------- scans


def _bucketed(df: DataFrame, time_col: str, group_cols: Sequence[str], bucket_us: int) -> DataFrame:
    """Add the time in microseconds and ``_bk_key``, the (series, bucket) as one struct that is never NULL."""
    t = epoch_us(time_col)
    keys = [F.col(c).alias(f"s{i}") for i, c in enumerate(group_cols)]
    return df.withColumn(_T, t).withColumn("_bk_key", F.struct(*keys, F.floor(F.col(_T) / F.lit(bucket_us)).alias("bk")))


def _series(n: int) -> Column:
    return F.struct(*[F.col("_bk_key")[f"s{i}"].alias(f"s{i}") for i in range(n)]) if n else F.struct(F.lit(0).alias("s0"))


def _carried(summary: DataFrame, n: int, before: Mapping[str, Column], after: Mapping[str, Column]) -> DataFrame:
    """Last values before and first values after each bucket of a series; one row per (series, bucket)."""
    summary = summary.withColumns({"_series": _series(n), "_bk_no": F.col("_bk_key")["bk"]})
    ws = Window.partitionBy("_series").orderBy("_bk_no")
    back, ahead = ws.rowsBetween(Window.unboundedPreceding, -1), ws.rowsBetween(1, Window.unboundedFollowing)
    return summary.select(
        "_bk_key", *[F.last(c, ignorenulls=True).over(back).alias(k) for k, c in before.items()],
        *[F.first(c, ignorenulls=True).over(ahead).alias(k) for k, c in after.items()])


def _fill_scan(df: DataFrame, value_col: str, time_col: str, group_cols: Sequence[str], bucket_us: int) -> DataFrame:
    """Previous (``_prev_v``) and next (``_next_v``) valid value of every row.

    The window and the join share the exchange on (series, bucket); the summary
    is a partial aggregate of the input, not of the window's output.
    """
    x, n = F.col(value_col), len(group_cols)
    d = _bucketed(df, time_col, group_cols, bucket_us)
    valid_t = F.when(x.isNotNull(), F.col(_T))
    summary = d.groupBy("_bk_key").agg(F.max_by(x, valid_t).alias("_lv"), F.min_by(x, valid_t).alias("_fv"))
    carried = _carried(summary, n, {"_cpv": F.col("_lv")}, {"_cnv": F.col("_fv")})
    wb = Window.partitionBy("_bk_key").orderBy(_T)
    d = d.withColumns({"_pv": F.last(x, ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, 0)),
                       "_nv": F.first(x, ignorenulls=True).over(wb.rowsBetween(0, Window.unboundedFollowing))})
    return d.join(carried, "_bk_key", "left").withColumns(
        {"_prev_v": F.coalesce("_pv", "_cpv"), "_next_v": F.coalesce("_nv", "_cnv")})


def _segment_scan(df: DataFrame, value_col: str, time_col: str, group_cols: Sequence[str],
                  bucket_us: int) -> DataFrame:
    """Previous/next valid value (and their positions) for every row.

    Adds ``_pos`` (1-based row position in the series), ``_prev_v``/``_prev_p``
    (last non-null value at or before the row) and ``_next_v``/``_next_p``
    (first non-null value at or after the row). Positions need the row numbers
    of the buckets, so the numbered rows are written once to the shared folder
    and read by both the summary and the join.
    """
    x, n = F.col(value_col), len(group_cols)
    wb = Window.partitionBy("_bk_key").orderBy(_T)
    d = _bucketed(df, time_col, group_cols, bucket_us).withColumn("_rn", F.row_number().over(wb))
    valid_rn = F.when(x.isNotNull(), F.col("_rn"))
    upto, onward = wb.rowsBetween(Window.unboundedPreceding, 0), wb.rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumns({
        "_pv": F.last(x, ignorenulls=True).over(upto), "_pr": F.last(valid_rn, ignorenulls=True).over(upto),
        "_nv": F.first(x, ignorenulls=True).over(onward), "_nr": F.first(valid_rn, ignorenulls=True).over(onward),
    })
    d = materialize(d, "series-scan")
    summary = d.groupBy("_bk_key").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(x, valid_rn).alias("_lv"), F.max(valid_rn).alias("_lr"),
        F.min_by(x, valid_rn).alias("_fv"), F.min(valid_rn).alias("_fr"))
    summary = summary.withColumns({"_series": _series(n), "_bk_no": F.col("_bk_key")["bk"]})
    ws = Window.partitionBy("_series").orderBy("_bk_no")
    offset = F.coalesce(F.sum("_n").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summary = summary.withColumn("_off", offset)
    carried = _carried(summary, n, {"_cpv": F.col("_lv"), "_cpp": F.col("_off") + F.col("_lr")},
                       {"_cnv": F.col("_fv"), "_cnp": F.col("_off") + F.col("_fr")})
    j = d.join(summary.select("_bk_key", "_off").join(carried, "_bk_key"), "_bk_key", "left")
    return j.withColumns({
        "_pos": F.col("_off") + F.col("_rn"),
        "_prev_v": F.coalesce("_pv", "_cpv"), "_prev_p": F.coalesce(F.col("_off") + F.col("_pr"), F.col("_cpp")),
        "_next_v": F.coalesce("_nv", "_cnv"), "_next_p": F.coalesce(F.col("_off") + F.col("_nr"), F.col("_cnp")),
    })


def fill_segment(
    df: DataFrame,
    value_col: str,
    time_col: str,
    group_cols: Sequence[str],
    default: float | None = None,
    out_col: str | None = None,
    bucket_days: int = 28,
) -> DataFrame:
    """Back-fill, then forward-fill inside each series, then ``default``.

    Unlike the pandas chain it replaces, the forward fill never crosses into
    another series.
    """
    cols = list(df.columns)
    s = _fill_scan(df, value_col, time_col, group_cols, bucket_days * DAY_US)
    filled = F.coalesce(F.col(value_col), F.col("_next_v"), F.col("_prev_v"))
    if default is not None:
        filled = F.coalesce(filled, F.lit(default))
    target = out_col or value_col
    s = s.withColumn("_filled", filled)
    return s.select(*[F.col("_filled").alias(c) if c == target else F.col(c) for c in cols],
                    *([] if target in cols else [F.col("_filled").alias(target)]))


def interpolate_segment(
    df: DataFrame,
    value_col: str,
    time_col: str,
    group_cols: Sequence[str],
    out_col: str | None = None,
    bucket_days: int = 28,
) -> DataFrame:
    """Linear interpolation by row position inside each series.

    Leading nulls stay null, interior nulls are interpolated between the
    surrounding valid values by position, trailing nulls take the last valid
    value.
    """
    cols = list(df.columns)
    s = _segment_scan(df, value_col, time_col, group_cols, bucket_days * DAY_US)
    x = F.col(value_col)
    pv, pp, nv, np_ = F.col("_prev_v"), F.col("_prev_p"), F.col("_next_v"), F.col("_next_p")
    interp = (
        F.when(x.isNotNull(), x)
        .when(pv.isNotNull() & nv.isNotNull(), pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp))
        .when(pv.isNotNull(), pv)
    )
    target = out_col or value_col
    s = s.withColumn("_interp", interp)
    return s.select(*[F.col("_interp").alias(c) if c == target else F.col(c) for c in cols],
                    *([] if target in cols else [F.col("_interp").alias(target)]))


# ---------------------------------------------------------------- dedupe


def keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order_cols``.

    Expressed as ``max_by`` in an aggregate, so duplicates are combined
    map-side before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_r"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest ``order_cols`` (default: all other columns)."""
    others = [c for c in df.columns if c not in keys]
    order = list(order_cols) if order_cols else others
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


# ---------------------------------------------------------------- report windows


def period_over_period(df: DataFrame, order_col: str, value_col: str,
                       partition_cols: Sequence[str] = (), prefix: str = "MoM") -> DataFrame:
    """Difference and % change to the previous row by ``order_col``.

    Meant for one row per period (months): the input is an aggregate, so even
    an unpartitioned window holds only as many rows as there are periods.
    """
    w = Window.partitionBy(*partition_cols).orderBy(order_col) if partition_cols else Window.orderBy(order_col)
    prev = F.lag(value_col).over(w)
    x = F.col(value_col)
    return df.withColumn("_prev", prev).withColumns(
        {
            f"{prefix}_diff": x - F.col("_prev"),
            f"{prefix}_diff_pct": F.try_divide(x - F.col("_prev"), F.col("_prev")) * 100.0,
        }
    ).drop("_prev")


def moving_average(df: DataFrame, order_col: str, value_col: str, sizes: Sequence[int],
                   partition_cols: Sequence[str] = (), name: str = "{value}_MA_{n}d") -> DataFrame:
    """Trailing row-count moving averages ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``."""
    w = Window.partitionBy(*partition_cols).orderBy(order_col) if partition_cols else Window.orderBy(order_col)
    return df.withColumns(
        {name.format(value=value_col, n=n): F.avg(value_col).over(w.rowsBetween(-(n - 1), 0)) for n in sizes}
    )
