"""Rolling-origin backtest: folds, membership, baselines, scores, Spark ML.

Folds are tiny DataFrames derived from the data's time bounds (one global
aggregate) with ``explode(sequence(...))`` — no driver loop over data. Each row
generates the folds of a scalar array that it falls into. ``boosted_backtest``
trains all folds, segments and parameters in the same jobs. ``backtest_models``
fits Spark ML estimators: every fit is distributed over the rows of its
(fold, segment); the independent fits are submitted a few at a time from a small
driver thread pool, as ``CrossValidator(parallelism=...)`` does; boosted trees on numbers
without early stopping are fitted by :mod:`hourgrid.plans.block_trees`. The feature table
is materialised once (time-sorted Parquet in the shared checkpoint folder) so fits
skip row groups outside their fold instead of recomputing features. Training rows
never reach the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions.scalar import abs_error, epoch_us, trunc_ts
from hourgrid.plans.block_trees import fit_blocks, fits_blocks
from hourgrid.plans.boosting import Boosted, BoostParams, Halving, Patience, boost, gain_totals

__all__ = [
    "month_folds",
    "share_folds",
    "assign_folds",
    "sample_holdout",
    "holdout_split",
    "naive_predictions",
    "fold_scores",
    "fold_scores_by_slices",
    "FitSpec",
    "feature_columns",
    "fit_predict",
    "backtest_models",
    "boosted_backtest",
    "BoostedBacktest",
    "feature_importances",
    "sample_candidates",
]

NS_PER_DAY = 86_400_000_000_000
#: Rows of the feature table that one training task reads and keeps (some 400 bytes each), and bytes of the table's row groups.
TASK_ROWS, GROUP_BYTES = 250_000, 2 << 20


def _ts(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp_ntz")


def month_folds(df: DataFrame, time_col: str, train_range: int, test_range: int, shift: int, splits: int,
                start: Any = None) -> DataFrame:
    """Expanding month folds.

    Fold ``i``: train ``[start, start + (train_range + shift*i) months - 1h]``,
    test the next ``test_range`` months minus one hour. ``start`` defaults to
    the first timestamp of ``df``. Month arithmetic clamps to month end and
    keeps the time of day. (Named "sliding" in the source, the train window
    actually expands: its start never moves.)
    """
    base = df.agg(F.min(time_col).alias("start")) if start is None else df.sparkSession.range(1).select(
        _ts(start).alias("start"))
    i = F.col("fold")
    s = F.col("start")
    cut = F.timestamp_add("MONTH", F.lit(train_range) + i * shift, s)
    end = F.timestamp_add("MONTH", F.lit(train_range + test_range) + i * shift, s)
    one_h = F.expr("INTERVAL 1 HOUR")
    return base.select(F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("fold"), "start").select(
        F.lit("test").alias("kind"), i.cast("int").alias("fold"), s.alias("train_start"),
        (cut - one_h).alias("train_end"), cut.alias("test_start"), (end - one_h).alias("test_end"),
    )


def share_folds(df: DataFrame, time_col: str, train_share: float = 0.64, val_share: float = 0.16,
                n_val_splits: int = 3, n_test_splits: int = 3, fh: int = 7, expanding: bool = False) -> DataFrame:
    """Validation and test folds from shares of the day range.

    Days are counted from the first to the last calendar day. Train covers
    ``ceil(days * train_share)`` days, validation ``ceil(days * val_share)``,
    test the rest. ``n`` folds step by ``ceil(range / n)`` days; each fold
    tests ``fh`` days. ``expanding`` keeps the train start fixed, otherwise it
    slides with the fold. Output: kind ('val'/'test'), fold, train/test bounds.
    """
    if train_share + val_share >= 1.0:
        raise ValueError(f"no days left for testing: train and validation take {train_share + val_share:.0%}")
    day = F.to_date(time_col)
    b = df.agg(F.min(day).alias("d0"), F.max(day).alias("d1"))
    d0 = F.col("d0").cast("timestamp_ntz")
    total = (F.datediff("d1", "d0") + 1).cast("long")

    def ceil_days(days: Column, share: float) -> Column:
        # Same arithmetic as a nanosecond duration times a float, ceiled to days.
        return F.ceil((days * F.lit(NS_PER_DAY)).cast("double") * F.lit(share) / F.lit(float(NS_PER_DAY)))

    b = b.select(
        d0.alias("train_start0"),
        (F.col("d1").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("end_excl"),
        ceil_days(total, train_share).alias("train_days"),
        ceil_days(total, val_share).alias("val_days"),
    )
    one_h = F.expr("INTERVAL 1 HOUR")
    fh_span = F.make_dt_interval(F.lit(fh - 1), F.lit(23))
    ts0 = F.col("train_start0")
    val_start = F.timestamp_add("DAY", F.col("train_days"), ts0)
    test_start = F.timestamp_add("DAY", F.col("train_days") + F.col("val_days"), ts0)
    test_hours = F.timestamp_diff("HOUR", test_start, F.col("end_excl"))
    b = b.select(
        "*", val_start.alias("val_start"), test_start.alias("test_start0"),
        F.ceil(F.col("val_days") / F.lit(n_val_splits)).alias("val_step"),
        F.ceil(test_hours / F.lit(24.0 * n_test_splits)).alias("test_step"),
    )
    slide = 0 if expanding else 1
    i = F.col("fold")
    val = b.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_val_splits - 1))).alias("fold")).select(
        F.lit("val").alias("kind"), i.cast("int").alias("fold"),
        F.timestamp_add("DAY", i * F.col("val_step") * slide, ts0).alias("train_start"),
        (F.timestamp_add("DAY", i * F.col("val_step"), F.col("val_start")) - one_h).alias("train_end"),
        F.timestamp_add("DAY", i * F.col("val_step"), F.col("val_start")).alias("test_start"),
        (F.timestamp_add("DAY", i * F.col("val_step"), F.col("val_start")) + fh_span).alias("test_end"),
    )
    test = b.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_test_splits - 1))).alias("fold")).select(
        F.lit("test").alias("kind"), i.cast("int").alias("fold"),
        F.timestamp_add("DAY", (F.col("val_days") + i * F.col("test_step")) * slide, ts0).alias("train_start"),
        (F.timestamp_add("DAY", i * F.col("test_step"), F.col("test_start0")) - one_h).alias("train_end"),
        F.timestamp_add("DAY", i * F.col("test_step"), F.col("test_start0")).alias("test_start"),
        (F.timestamp_add("DAY", i * F.col("test_step"), F.col("test_start0")) + fh_span).alias("test_end"),
    )
    return val.unionByName(test)


def assign_folds(df: DataFrame, folds: DataFrame, time_col: str, eval_days: int | None = 21) -> DataFrame:
    """Label each row with its fold(s) and part: train / eval / test.

    A row belongs to fold ``f`` when ``train_start <= t <= test_end``; it is
    ``test`` inside the test bounds, ``eval`` in the last ``eval_days`` of the
    train window (from midnight of the last train day), else ``train``.
    ``eval_days=None`` keeps the whole train window as train. The fold list (one
    entry per split) is a scalar array; each row generates the folds that it
    falls into, so there is no join.
    """
    t = F.col(time_col)
    listed = folds.agg(F.collect_list(F.struct(*folds.columns))).scalar()
    hit = F.filter(F.col("_folds"), lambda f: (t >= f["train_start"]) & (t <= f["test_end"]))
    j = df.withColumn("_folds", listed).select(*df.columns, F.inline(hit))
    part = F.when(t >= F.col("test_start"), F.lit("test"))
    if eval_days:
        eval_start = F.timestamp_add("DAY", F.lit(-eval_days), trunc_ts("day", "train_end"))
        part = part.when(t >= eval_start, F.lit("eval"))
    return j.withColumn("part", part.otherwise(F.lit("train")))


def sample_holdout(df: DataFrame, n: int, keys: Sequence[str], seed: int = 10) -> DataFrame:
    """Seeded sample of ``min(n, rows)`` rows (T4).

    Rows are ranked by ``xxhash64(keys, seed)``; the same rows come back under
    any partitioning. Plans as TakeOrderedAndProject (per-partition top-n, then
    a merge of n rows per partition).
    """
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


def holdout_split(df: DataFrame, n: int, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A repeatable sample of ``min(n, rows)`` rows and the remainder (T4).

    Rows are ordered by the MD5 of their keys, the keys, and a hash of the row, so the split is the same
    under any partitioning. Only the last row of the sample is looked up. Rows equal to it in the whole
    order are counted and dealt to both parts, so that the sample has exactly ``n`` rows.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    row = F.xxhash64(*[F.col(f.name).cast("string") if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields])
    place = F.struct(F.md5(text.cast("binary")).alias("h"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], row.alias("row"))
    h = df.withColumn("_at", place)
    first = h.select("_at").orderBy("_at").limit(n)
    edge = first.agg(F.max("_at").alias("m")).scalar()
    taken = first.groupBy("_at").agg(F.count(F.lit(1)).alias("c")).agg(F.max_by("c", "_at")).scalar()
    equal = h.filter(F.col("_at") == edge).groupBy("_at").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))

    def copies(times: Column) -> DataFrame:
        return equal.select("_row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("_row.*")

    before, after = h.filter(F.col("_at") < edge), h.filter(F.coalesce(F.col("_at") > edge, F.lit(True)))
    return before.drop("_at").unionByName(copies(taken)), after.drop("_at").unionByName(copies(F.col("_n") - taken))


def naive_predictions(df: DataFrame, lag_col: str = "target_lag_2d", pred_col: str = "preds") -> DataFrame:
    """Baseline forecast: the lagged value; rows without one are not scored (M5)."""
    return df.filter(F.col(lag_col).isNotNull()).withColumn(pred_col, F.col(lag_col))


def fold_scores(pred: DataFrame, keys: Sequence[str], target: str = "target", pred_col: str = "preds") -> DataFrame:
    """MAE and scored-row count per group."""
    e = abs_error(target, pred_col)
    return pred.groupBy(*keys).agg(F.avg(e).alias("mae"), F.count(e).cast("long").alias("n_scored"))


def fold_scores_by_slices(pred: DataFrame, folds: DataFrame, time_col: str, keys: Sequence[str], eval_days: int | None = 21,
                          target: str = "target", pred_col: str = "preds") -> DataFrame:
    """:func:`fold_scores` of :func:`assign_folds` per (kind, fold, ``keys``, part), each row read once.

    Expanding folds overlap, and :func:`assign_folds` copies a row into each of them. Here the bounds of
    all folds cut the time line into slices; rows are summed per (slice, keys), and a part of a fold sums its
    slices. The bounds are a scalar array; everything after the sums has folds x slices rows per key.
    """
    t = epoch_us(time_col)
    us = {c: epoch_us(c) for c in ("train_start", "train_end", "test_start", "test_end")}
    day = 86_400_000_000
    eval_from = F.greatest(us["train_start"], F.floor(us["train_end"] / day) * day - eval_days * day) if eval_days else us["test_start"]
    eval_from = F.least(eval_from, us["test_start"])
    known = folds.select("kind", "fold", F.array(
        *[F.struct(F.lit(name).alias("part"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi")) for name, lo, hi in (
            ("train", us["train_start"], eval_from), ("eval", eval_from, us["test_start"]), ("test", us["test_start"], us["test_end"] + 1))]).alias("parts"))
    parts = known.select("kind", "fold", F.inline("parts")).filter("lo < hi")
    bounds = parts.select(F.explode(F.array("lo", "hi")).alias("b")).agg(F.array_sort(F.collect_set("b"))).scalar()
    e = abs_error(target, pred_col)
    number = lambda x: F.size(F.filter("_bounds", lambda b: b <= x))
    cut = pred.select(*keys, e.alias("_e"), t.alias("_t"), bounds.alias("_bounds")).withColumn("_slice", number(F.col("_t")))
    sums = cut.filter(F.col("_t").isNotNull()).groupBy("_slice", *keys).agg(F.sum("_e").alias("_s"), F.count("_e").alias("_n"))
    wanted = parts.withColumn("_bounds", bounds).select("kind", "fold", "part", F.explode(F.sequence(number(F.col("lo")), number(F.col("hi")) - 1)).alias("_slice"))
    out = wanted.join(sums, "_slice").groupBy("kind", "fold", *keys, "part").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    return out.select("kind", "fold", *keys, "part", (F.col("_s") / F.when(F.col("_n") > 0, F.col("_n"))).alias("mae"), F.col("_n").cast("long").alias("n_scored"))


# ---------------------------------------------------------------- Spark ML


@dataclass(frozen=True)
class FitSpec:
    """One model configuration (M1, M2)."""

    label: str
    kind: str = "gbt"                    # gbt | linear | glm
    params: Mapping[str, Any] | None = None


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical (string/boolean) feature columns."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return num, cat


def _estimator(spec: FitSpec, label: str, with_validation: bool):
    from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression

    p = dict(spec.params or {})
    if spec.kind == "gbt":
        p.setdefault("maxIter", 20)
        p.setdefault("maxDepth", 5)
        p.setdefault("seed", 10)
        if with_validation:
            # Spark stops when the relative gain on the eval rows drops below
            # validationTol; its default (0.01) stops after the first tree at
            # small step sizes, so a finer tolerance stands in for the
            # patience-based early stopping of the original.
            p.setdefault("validationIndicatorCol", "_is_eval")
            p.setdefault("validationTol", 1e-4)
        return GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="preds", **p)
    if spec.kind == "linear":
        return LinearRegression(featuresCol="_features", labelCol=label, predictionCol="preds", **p)
    if spec.kind == "glm":
        return GeneralizedLinearRegression(featuresCol="_features", labelCol=label, predictionCol="preds", **p)
    raise ValueError(f"unknown model kind {spec.kind!r}")


def fit_predict(train: DataFrame, test: DataFrame, spec: FitSpec, label: str, num: Sequence[str],
                cat: Sequence[str], use_eval: bool = True):
    """Fit Imputer → StringIndexer → VectorAssembler → regressor; predict ``test`` (M1, M3).

    Trees get no missing values (median imputation first); string/boolean
    columns are indexed with unseen values kept. With ``use_eval`` rows whose
    ``part`` is 'eval' drive GBT early stopping through
    ``validationIndicatorCol`` and are not used as training rows. Trees on numbers without
    early stopping, whose parameters it knows, are fitted by :mod:`hourgrid.plans.block_trees`,
    whose splits are those of Spark ML.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler

    num = list(num)
    cat = list(cat)
    stages = []
    num_in = [f"_n_{c}" for c in num]
    tr = train.select(*[F.col(c).cast("double").alias(f"_n_{c}") for c in num],
                      *[F.col(c).cast("string").alias(f"_c_{c}") for c in cat], label, "part")
    te = test.select(*[F.col(c).cast("double").alias(f"_n_{c}") for c in num],
                     *[F.col(c).cast("string").alias(f"_c_{c}") for c in cat], label, "part",
                     *[F.col(c).alias(f"_keep_{c}") for c in test.columns if c not in (label, "part")])
    tr = tr.withColumn("_is_eval", F.col("part") == "eval")
    # a feature without any value in the train rows has no median and is left out;
    # without eval rows there is nothing to stop early on
    own = ~F.col("_is_eval")
    seen = tr.agg(F.count_if(F.col("_is_eval")).alias("_eval"), F.count_if(own).alias("_own"),
                  *[F.count_if(own & F.col(c).isNotNull() & ~F.isnan(c)).alias(c) for c in num_in]).first()
    num_in = [c for c in num_in if seen[c]]
    with_val = use_eval and spec.kind == "gbt" and seen["_eval"] > 0
    if not with_val:
        tr = tr.filter(own)
    imputer = Imputer(inputCols=num_in, outputCols=[f"{c}_i" for c in num_in], strategy="median").fit(tr.filter(own)) if num_in else None
    if cat:
        stages.append(StringIndexer(inputCols=[f"_c_{c}" for c in cat], outputCols=[f"_ix_{c}" for c in cat],
                                    handleInvalid="keep"))
    assembled = [f"{c}_i" for c in num_in] + [f"_ix_{c}" for c in cat]
    stages.append(VectorAssembler(inputCols=assembled, outputCol="_features", handleInvalid="keep"))
    if imputer:
        tr = imputer.transform(tr)
    if spec.kind == "gbt" and not with_val and num_in and not cat and fits_blocks(spec.params):
        fitted = [*stages, fit_blocks(tr, assembled, label, seen["_own"], spec.params)]
    else:
        fitted = Pipeline(stages=[*stages, _estimator(spec, label, with_val)]).fit(tr).stages
    model = PipelineModel(stages=[*([imputer] if imputer else []), *fitted])
    pred = model.transform(te.withColumn("_is_eval", F.lit(False)))
    keep = [c for c in pred.columns if c.startswith("_keep_")]
    out = pred.select(*[F.col(c).alias(c[len("_keep_"):]) for c in keep], label, "preds")
    return model, out, assembled


@contextmanager
def _task_rows(feats: DataFrame, rows: int):
    """Inside, a task scans about ``rows`` rows of a written table at most, whatever its size and however well it is packed."""
    spark, name = feats.sparkSession, "spark.sql.files.maxPartitionBytes"
    files = feats.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    held = files.groupBy("path").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n")).agg(F.sum("size").alias("size"), F.sum("n").alias("n")).first()
    old = spark.conf.get(name)
    if held["n"] and held["n"] > rows:
        # rows so wide that Spark's default (128 MB) holds fewer of them keep it
        spark.conf.set(name, str(min(128 << 20, max(1, held["size"] * rows // held["n"]))))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def backtest_models(
    df: DataFrame,
    folds: DataFrame,
    time_col: str,
    segment_cols: Sequence[str],
    specs: Sequence[FitSpec],
    label: str = "target",
    exclude: Sequence[str] = (),
    eval_days: int | None = 21,
    parallelism: int = 8,
    on_model: Callable[[dict, Any, list[str]], None] | None = None,
) -> DataFrame:
    """Train one model per (fold, segment, spec) and predict the fold's test rows (M1-M4).

    The feature table is written once, partitioned by segment and sorted by time
    inside each task, under the shared checkpoint folder; each fit's time-range filter is pushed to
    the Parquet scan and skips row groups outside its fold. Spark ML keeps a fit's rows in the parts in which
    they were scanned, so a part is about ``TASK_ROWS`` rows at most. Train / eval / test come from the fold's literal bounds. The fold table and the segment values
    are the only things brought to the driver. Returns the union of the
    prediction tables with fold, segment, model label, target and preds.
    """
    from hourgrid.session import materialize

    fold_rows = folds.collect()
    # a segment's fits read only its own folder
    feats = materialize(df, "features", partition_by=list(segment_cols), sort_by=[*segment_cols, time_col], options={"parquet.block.size": GROUP_BYTES})
    segments = feats.select(*segment_cols).distinct().collect()
    drop = set(exclude) | {time_col, label, *segment_cols}
    num, cat = feature_columns(df, sorted(drop))
    t = F.col(time_col)

    def run(args):
        fold, seg, spec = args
        cond = t.between(F.lit(fold["train_start"]), F.lit(fold["test_end"]))
        for k in segment_cols:
            cond = cond & F.col(k).eqNullSafe(F.lit(seg[k]))
        part = F.when(t >= F.lit(fold["test_start"]), F.lit("test"))
        if eval_days:
            eval_start = F.timestamp_add("DAY", F.lit(-eval_days), trunc_ts("day", F.lit(fold["train_end"])))
            part = part.when(t >= eval_start, F.lit("eval"))
        rows = feats.filter(cond).withColumn("part", part.otherwise(F.lit("train")))
        rows = rows.withColumns({"kind": F.lit(fold["kind"]), "fold": F.lit(fold["fold"])})
        train = rows.filter(F.col("part") != "test")
        test = rows.filter(F.col("part") == "test")
        model, pred, assembled = fit_predict(train, test, spec, label, num, cat, use_eval=bool(eval_days))
        if on_model is not None:
            on_model({"kind": fold["kind"], "fold": fold["fold"], **seg.asDict(), "model_label": spec.label},
                     model, assembled)
        return pred.withColumn("model_label", F.lit(spec.label))

    jobs = [(f, s, sp) for f in fold_rows for s in segments for sp in specs]
    with _task_rows(feats, TASK_ROWS), ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        preds = list(pool.map(run, jobs))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


def boosted_backtest(
    df: DataFrame,
    folds: DataFrame,
    time_col: str,
    segment_cols: Sequence[str],
    specs: Mapping[str, BoostParams],
    label: str = "target",
    exclude: Sequence[str] = (),
    eval_days: int | None = 21,
    bins: int = 64,
    patience: int | None = None,
    halving: tuple[int, int] | None = None,
) -> BoostedBacktest:
    """All folds, segments and parameters as one training run of :mod:`hourgrid.plans.boosting` (M1-M4, M6, M7).

    Rows get their folds and parts by :func:`assign_folds`, so a row is copied once per fold and
    parameter set that it takes part in, and every tree level of every model is one query. Missing
    values stay missing. The round of the lowest error on the eval rows is kept; ``patience`` stops a
    model after so many rounds without gain. ``halving`` = (rounds of the first rung, eta) drops
    candidates by their mean error over folds and segments on the eval rows, or on the test rows if
    ``eval_days`` is None. Only folds x segments reach the driver.
    """
    spark = df.sparkSession
    num, cat = feature_columns(df, sorted({*exclude, time_col, label, *segment_cols}))
    listed = assign_folds(df, folds, time_col, eval_days)
    keys = ["kind", "fold", *segment_cols]
    groups = sorted(folds_of(listed, keys), key=lambda r: tuple(str(x) for x in r))
    names = list(specs)
    if not groups:
        raise ValueError("no row falls into a fold")
    schema = T.StructType([*[listed.schema[k] for k in keys], T.StructField("_group", T.IntegerType())])
    numbers = spark.createDataFrame([(*r, i) for i, r in enumerate(groups)], schema)
    same = [listed[k].eqNullSafe(numbers[k]) for k in keys]
    rows = listed.join(F.broadcast(numbers), same).select(listed["*"], "_group")
    rows = rows.withColumn("model", F.explode(F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda s: F.col("_group") * len(names) + s)))
    params = [specs[name] for _ in groups for name in names]
    part = "eval" if eval_days else "test"
    stoppers: list[Any] = [Patience(patience, "eval")] if patience else []
    rule = Halving({m: m % len(names) for m in range(len(params))}, halving[0], halving[1], part) if halving else None
    keep = [c for c in df.columns if c != label]
    fit = boost(rows, params, num + cat, label, bins, keep, [*stoppers, *([rule] if rule else [])], "eval")
    meta = spark.createDataFrame([(*r, i * len(names) + j, name) for i, r in enumerate(groups) for j, name in enumerate(names)],
                                 T.StructType([*[listed.schema[k] for k in keys], T.StructField("model", T.IntegerType()), T.StructField("model_label", T.StringType())]))
    told = meta.drop(*segment_cols)
    preds = fit.predictions.filter(F.col("part") == "test").join(F.broadcast(told), "model")
    return BoostedBacktest(fit, meta, preds.select(*keep, label, "preds", "kind", "fold", "model_label"), rule, names)


def folds_of(rows: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """The distinct (kind, fold, segment) of labelled rows: folds x segments values."""
    return [tuple(r) for r in rows.select(*keys).distinct().collect()]


@dataclass
class BoostedBacktest:
    """A fit with its models: ``models`` (kind, fold, segments, model, model_label), test ``predictions``, the ``halving`` rule."""

    fit: Boosted
    models: DataFrame
    predictions: DataFrame
    halving: Halving | None
    names: Sequence[str]

    def round_errors(self) -> DataFrame:
        """Errors of every round with the model's fold, segment and label."""
        return self.fit.errors.join(F.broadcast(self.models), "model")

    def gains(self, keys: Sequence[str]) -> DataFrame:
        """Total gain per ``keys`` (of ``models``) and feature."""
        return gain_totals(self.fit.trees.join(F.broadcast(self.models), "model"), keys)

    def rungs(self) -> DataFrame:
        """(rung, rounds, model_label, mean_error, survives) of the halving."""
        rows = [(rung, n, self.names[c], float(e), s) for rung, n, c, e, s in (self.halving.rungs if self.halving else [])]
        return self.models.sparkSession.createDataFrame(rows, "rung int, rounds int, model_label string, mean_error double, survives boolean")


def feature_importances(model, assembled: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) pairs of a fitted tree pipeline (M7)."""
    last = model.stages[-1]
    imp = last.featureImportances.toArray() if hasattr(last, "featureImportances") else []
    names = [n[len("_n_"):-2] if n.startswith("_n_") else n[len("_ix_"):] for n in assembled]
    return [(n, float(v)) for n, v in zip(names, imp)]


def sample_candidates(space: Mapping[str, Any], n_candidates: int = 4, seed: int = 10,
                      kind: str = "gbt", base: Mapping[str, Any] | None = None) -> list[FitSpec]:
    """Seeded random candidates from a search space (M6).

    A list/set of values is a categorical choice; a ``(lo, hi)`` tuple is a
    uniform range (integers when both ends are ints). Duplicates are skipped;
    a space of choices that holds fewer candidates than asked for is an error.
    """
    sizes = [len(d) if not (isinstance(d, tuple) and len(d) == 2) else
             (d[1] - d[0] + 1 if all(isinstance(x, int) for x in d) else math.inf) for d in space.values()]
    if math.prod(sizes) < n_candidates:
        raise ValueError(f"{n_candidates} candidates asked for, the space holds {math.prod(sizes)}")
    rng = random.Random(seed)
    keys = sorted(space)
    out, seen = [], set()
    while len(out) < n_candidates:
        params = {}
        for k in keys:
            dom = space[k]
            if isinstance(dom, tuple) and len(dom) == 2:
                lo, hi = dom
                params[k] = rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rng.uniform(lo, hi)
            else:
                params[k] = rng.choice(list(dom))
        sig = tuple(params[k] for k in keys)
        if sig not in seen:
            seen.add(sig)
            out.append(FitSpec(label=f"cand{len(out)}", kind=kind, params={**(base or {}), **params}))
    return out
