"""Gradient boosting by Spark aggregates: many models grow together (M1-M3, M6, M7).

A model is one (fold, segment, parameters). Rows carry the number of their model,
so the trees of all models grow in the same jobs, whatever their number:

1. Features become bins once: all values of a feature that has few, quantiles of
   one that has many, the most frequent values of a text; bin 0 is "missing".
2. A level of all trees is one query: gradient sums per (model, node, feature,
   bin), running sums over the bins, the best split of each node. Missing values
   go to the side that gains more. Only sums leave the tasks; the driver sees one
   row per node.
3. A finished tree moves each row's prediction. Train, eval and test rows move
   alike, so errors per round are one aggregate, and the test rows' predictions are
   there when training ends, taken at the best round.

Any loss with a gradient works: squared, absolute (leaves are medians), Huber,
Tweedie (log link). Rows and features are sampled by hash, so a lost task comes
back with the same rows. The state of the rows is cached and is written to the shared
folder every ``CUT`` rounds, which cuts the lineage.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["BoostParams", "Bins", "Boosted", "fit_bins", "boost", "predict", "gain_totals", "stopping_rounds", "halving_survivors", "Patience", "Halving"]

#: Rounds between two writes of the rows' state.
CUT = 10
#: Decimals of a split's gain, as a share of the node's squared gradients, that decide; ties go to the first feature, then bin.
GAIN_DIGITS = 9
PARTS = ("train", "eval", "test")

TREE_SCHEMA = ("model int, round int, node int, feature string, threshold double, threshold_text string, bin int, missing_left boolean, "
               "gain double, n_rows long, value double")
ERROR_SCHEMA = "model int, round int, part string, n_rows long, error double"


@dataclass(frozen=True)
class BoostParams:
    """Parameters of one model."""

    loss: str = "squared"            # squared | absolute | huber | tweedie
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 5
    min_rows: int = 20
    min_gain: float = 0.0            # share of a node's squared gradients
    l2: float = 0.0
    alpha: float = 1.0               # huber: residual from which the loss is linear
    power: float = 1.5               # tweedie: variance power, 1 < power < 2
    rows_share: float = 1.0          # rows per tree
    features_share: float = 1.0      # features per tree

    def __post_init__(self):
        if self.loss not in _GRADIENTS:
            raise ValueError(f"unknown loss {self.loss!r}")


@dataclass(frozen=True)
class Bins:
    """How features become small numbers: sorted numeric edges, or the texts that have a bin of their own."""

    edges: Mapping[str, list]
    texts: frozenset = frozenset()

    @property
    def features(self) -> list[str]:
        return list(self.edges)

    def column(self, feature: str) -> Column:
        """0 for missing values (NULL, NaN, a text without a bin), else 1 for the lowest values, and so on."""
        values, c = self.edges[feature], F.col(f"`{feature}`")
        if feature in self.texts:
            found = F.array_position(_text_array(values), c.cast("string")) if values else F.lit(0)
            return F.coalesce(found, F.lit(0)).cast("tinyint")
        x = c.cast("double")
        above = F.size(F.filter(_literal(values, "double"), lambda e: e < x)) if values else F.lit(0)
        return F.when(x.isNull() | F.isnan(x), 0).otherwise(1 + above).cast("tinyint")

    def threshold(self, feature: str, bin_: int) -> tuple[float | None, str | None]:
        """The largest value (or text) of the left side of a split at ``bin_``; infinity parts values from missing ones."""
        edges = self.edges[feature]
        value = edges[bin_ - 1] if bin_ <= len(edges) else math.inf
        return (None, value) if feature in self.texts else (float(value), None)


@dataclass
class Boosted:
    """Trees, errors per round and predictions of all models; ``best`` is the last round kept of each."""

    trees: DataFrame
    errors: DataFrame
    predictions: DataFrame
    bins: Bins
    params: Sequence[BoostParams]
    base: Mapping[int, float]
    best: Mapping[int, int] = field(default_factory=dict)


# loss: (gradient, curvature) of a row with label y and score f as SQL; {a} is alpha, {p} the power
_GRADIENTS = {
    "squared": ("f - y", "1D"),
    "absolute": ("signum(f - y)", "1D"),
    "huber": ("greatest(-{a}, least({a}, f - y))", "1D"),
    "tweedie": ("-y * exp((1 - {p}) * f) + exp((2 - {p}) * f)", "y * ({p} - 1) * exp((1 - {p}) * f) + (2 - {p}) * exp((2 - {p}) * f)"),
}


def _literal(values: Iterable, kind: str) -> Column:
    """A constant array; one literal in the plan whatever its length."""
    return F.expr(_array_sql(values, kind))


def _array_sql(values: Iterable, kind: str) -> str:
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<{kind}>)"


def _text_array(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def fit_bins(df: DataFrame, features: Sequence[str], bins: int = 64) -> Bins:
    """Bins of numeric, boolean and text features from all rows of ``df``.

    A numeric feature with at most ``bins`` values gets one bin each, others get quantiles (mergeable
    sketches, rank error 1e-4). Of a text the ``bins`` most frequent values get one each. The driver
    sees at most ``bins`` + 1 rows per feature.
    """
    if not 2 <= bins <= 100:
        raise ValueError("bins must be 2 to 100")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in features if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in features if c not in texts]
    edges: dict[str, list] = {}
    if numbers:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in numbers])).alias("_"))
        long = long.select("_.feature", "_.value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
        few = Window.partitionBy("feature").orderBy("value")
        first = long.distinct().withColumn("k", F.row_number().over(few)).filter(F.col("k") <= bins + 1)
        values: dict[str, list[float]] = {}
        for r in first.collect():
            values.setdefault(r["feature"], []).append(r["value"])
        cuts = F.array(*[F.lit(k / bins) for k in range(1, bins)])
        many = [c for c in numbers if len(values.get(c, [])) > bins]
        if many:
            sketched = long.filter(F.col("feature").isin(many)).groupBy("feature").agg(F.percentile_approx("value", cuts, 10000).alias("e"))
            values.update({r["feature"]: sorted(set(r["e"])) for r in sketched.collect()})
        for c in numbers:
            edges[c] = values[c] if c in many else sorted(values.get(c, []))[:-1]
    if texts:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in texts])).alias("_"))
        counts = long.select("_.feature", "_.value").filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        top = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
        for r in counts.withColumn("k", F.row_number().over(top)).filter(F.col("k") <= bins).collect():
            edges.setdefault(r["feature"], []).append(r["value"])
        edges.update({c: sorted(edges.get(c, [])) for c in texts})
    return Bins({c: edges[c] for c in features}, frozenset(texts))


class _Trees:
    """Splits of the trees that grow in one round: per model a heap of nodes, root 1, children 2n and 2n + 1."""

    def __init__(self, models: int, depth: int):
        self.width = 2 ** (depth + 1)
        self.models = models
        self.split = [-1] * (models * self.width)   # feature << 8 | bin << 1 | missing goes left
        self.value = [0.0] * (models * self.width)

    def at(self, model: int, node: int) -> int:
        return model * self.width + node

    def down(self, src: str, levels: int) -> str:
        """SQL of ``src`` with each row's node after ``levels`` levels."""
        splits = _array_sql(self.split, "int")
        text = f"SELECT *, 1 AS node FROM {src}"
        for _ in range(levels):
            code = f"SELECT *, element_at({splits}, model * {self.width} + node + 1) AS code FROM ({text})"
            side = f"SELECT *, element_at(bins, if(code < 0, 1, shiftright(code, 8) + 1)) AS bin FROM ({code})"
            left = "CASE WHEN bin = 0 THEN code & 1 = 1 ELSE bin <= (shiftright(code, 1) & 127) END"
            text = f"SELECT * EXCEPT (node, code, bin), CASE WHEN code < 0 THEN node WHEN {left} THEN 2 * node ELSE 2 * node + 1 END AS node FROM ({side})"
        return text


def _case(models: Sequence[int], params: Sequence[BoostParams], text: Callable[[BoostParams], str]) -> str:
    """An expression that may differ by model; one form if it does not."""
    forms: dict[str, list[int]] = {}
    for m in models:
        forms.setdefault(text(params[m]), []).append(m)
    if len(forms) == 1:
        return next(iter(forms))
    whens = " ".join(f"WHEN model IN ({', '.join(map(str, who))}) THEN {form}" for form, who in forms.items())
    return f"CASE {whens} END"


def _gradient(which: int) -> Callable[[BoostParams], str]:
    return lambda p: "(" + _GRADIENTS[p.loss][which].format(a=f"{float(p.alpha)!r}D", p=f"{float(p.power)!r}D") + ")"


def _level(models: Sequence[int], params: Sequence[BoostParams], trees: _Trees, level: int, round_: int, features: int) -> str:
    """SQL of one level: per (model, node) its sums and best split, from the table ``state``.

    The sums are exchanged once more by node, where running sums and the best split need no other exchange.
    Rows that ended above the level have no bins; a filter on the node would be pushed below its levels and repeat their expressions.
    """
    share = _case(models, params, lambda p: f"{float(p.rows_share)!r}D")
    cols = _case(models, params, lambda p: f"{float(p.features_share)!r}D")
    sampled = "" if all(params[m].rows_share >= 1 for m in models) else f" AND pmod(xxhash64(row, {round_}), 1000000) < 1000000 * ({share})"
    some = " OR true" if all(params[m].features_share >= 1 for m in models) else \
        f" OR feature = pmod(xxhash64(model, {round_}), {features}) OR pmod(xxhash64(feature, model, {round_}), 1000000) < 1000000 * ({cols})"
    l2, least = _case(models, params, lambda p: f"{float(p.l2)!r}D"), _case(models, params, lambda p: str(p.min_rows))
    floor = _case(models, params, lambda p: f"{float(p.min_gain)!r}D")
    rows = f"(SELECT model, bins, row, y, f FROM {{state}} WHERE part = 'train' AND model IN ({', '.join(map(str, models))}){sampled})"
    over = "OVER (PARTITION BY model, node, feature"
    # the node's own sums come from one more feature, that of a single bin; it has no split
    return f"""
WITH grads AS (SELECT model, node, if(node >= {2 ** level}, concat(bins, array(1Y)), NULL) AS bins,
                      {_case(models, params, _gradient(0))} AS g, {_case(models, params, _gradient(1))} AS h FROM ({trees.down(rows, level)})),
hist AS (SELECT model, node, feature, bin, sum(g) AS g, sum(h) AS h, sum(g * g) AS gg, count(*) AS n
         FROM (SELECT model, node, g, h, posexplode_outer(bins) AS (feature, bin) FROM grads) WHERE feature IS NOT NULL GROUP BY model, node, feature, bin DISTRIBUTE BY model, node),
runs AS (SELECT model, node, feature, bin, sum(g) {over}) AS tg, sum(h) {over}) AS th, sum(gg) {over}) AS tgg, sum(n) {over}) AS tn,
                sum(if(bin = 0, g, 0D)) {over}) AS mg, sum(if(bin = 0, h, 0D)) {over}) AS mh, sum(if(bin = 0, n, 0L)) {over}) AS mn,
                sum(if(bin = 0, 0D, g)) {over} ORDER BY bin) AS lg, sum(if(bin = 0, 0D, h)) {over} ORDER BY bin) AS lh, sum(if(bin = 0, 0L, n)) {over} ORDER BY bin) AS ln
         FROM hist),
sides AS (SELECT model, node, feature, bin, tg, th, tgg, tn,
                 inline(array(struct(true AS to_left, lg + mg AS lg, lh + mh AS lh, ln + mn AS ln), struct(false AS to_left, lg, lh, ln))) FROM runs WHERE bin > 0),
gains AS (SELECT *, {l2} AS l2 FROM sides WHERE feature = {features}{some}),
scored AS (SELECT *, lg * lg / nullif(lh + l2, 0D) + (tg - lg) * (tg - lg) / nullif(th - lh + l2, 0D) - tg * tg / nullif(th + l2, 0D) AS gain,
                  ln >= ({least}) AND tn - ln >= ({least}) AND ln > 0 AND tn > ln AS fits FROM gains),
ranked AS (SELECT *, round(gain / nullif(tgg, 0D), {GAIN_DIGITS}) AS share FROM scored)
SELECT model, node, max(CASE WHEN fits AND share > ({floor}) THEN struct(share, -feature AS f, -bin AS b, to_left, gain, lg, lh, ln) END) AS best,
       max(CASE WHEN feature = {features} THEN struct(tg, th, tn) END) AS own
FROM ranked GROUP BY model, node"""


class Patience:
    """Stop a model after ``rounds`` rounds in which the error on ``part`` did not fall by more than ``least``."""

    def __init__(self, rounds: int, part: str = "eval", least: float = 0.0):
        self.rounds, self.part, self.least = rounds, part, least
        self.best: dict[int, tuple[float, int]] = {}

    def __call__(self, round_: int, errors: Mapping[tuple[int, str], float], active: Sequence[int]) -> set[int]:
        stop = set()
        for m in active:
            e = errors.get((m, self.part))
            if e is None:
                continue
            if m not in self.best or e < self.best[m][0] - self.least:
                self.best[m] = (e, round_)
            elif round_ - self.best[m][1] >= self.rounds:
                stop.add(m)
        return stop


class Halving:
    """Successive halving: at rung r, after ``first`` * ``eta`` ** r rounds, the best 1 / ``eta`` of the candidates go on.

    Training ends when one is left. A candidate is scored by the mean over its models (folds, segments) of their lowest error so far on
    ``part``. Survivors keep their trees: no candidate is fitted twice. ``rungs`` records (rung, rounds,
    candidate, mean error, survives).
    """

    def __init__(self, candidate_of: Mapping[int, int], first: int, eta: int = 2, part: str = "eval"):
        if eta < 2 or first < 1:
            raise ValueError("eta must be at least 2 and first at least 1")
        self.candidate_of, self.first, self.eta, self.part = dict(candidate_of), first, eta, part
        self.alive = set(self.candidate_of.values())
        self.lowest: dict[int, float] = {}
        self.rungs: list[tuple[int, int, int, float, bool]] = []
        self.rung, self.due = 0, first

    def __call__(self, round_: int, errors: Mapping[tuple[int, str], float], active: Sequence[int]) -> set[int]:
        for m in self.candidate_of:
            if (m, self.part) in errors:
                self.lowest[m] = min(self.lowest.get(m, float("inf")), errors[m, self.part])
        if round_ < self.due or len(self.alive) < 2:
            return set()
        means = {}
        for c in self.alive:
            own = [self.lowest[m] for m, d in self.candidate_of.items() if d == c and m in self.lowest]
            means[c] = sum(own) / len(own) if own else float("inf")
        keep = -(-len(self.alive) // self.eta)
        order = sorted(means, key=lambda c: (means[c], c))
        self.rungs += [(self.rung, round_, c, means[c], k < keep) for k, c in enumerate(order)]
        self.alive = set(order[:keep])
        self.rung, self.due = self.rung + 1, self.due * self.eta
        return {m for m, c in self.candidate_of.items() if c not in self.alive or len(self.alive) == 1}

    def winner(self) -> int:
        """The candidate of the lowest mean among those never dropped."""
        def mean(c: int) -> float:
            own = [self.lowest[m] for m, d in self.candidate_of.items() if d == c and m in self.lowest]
            return sum(own) / len(own) if own else float("inf")
        return min(self.alive, key=lambda c: (mean(c), c))


def boost(rows: DataFrame, params: Sequence[BoostParams], features: Sequence[str], label: str = "target", bins: Bins | int = 64,
          keep: Sequence[str] = (), stoppers: Sequence[Callable] = (), choose_by: str = "eval") -> Boosted:
    """Train ``params[m]`` on the rows whose ``model`` is m; a row may be given once per model.

    ``rows`` needs the columns ``model`` (0 to len(params) - 1) and ``part`` (train, eval or test). Rows
    without a label are not trained on and have no error, but a prediction. After each round the
    ``stoppers`` see its errors and name models to stop. The round of the lowest error on ``choose_by``
    is kept; a model without such rows keeps all rounds. Predictions: model, part, label, ``keep`` columns, preds.
    """
    from hourgrid.session import materialize

    spark, count = rows.sparkSession, len(params)
    bad = [c for c in {"model", "part", label, *features} if c not in rows.columns]
    if bad:
        raise ValueError(f"missing columns {sorted(bad)}")
    if not isinstance(bins, Bins):
        bins = fit_bins(rows.filter(F.col("part") == "train"), features, bins)
    names = bins.features
    state = materialize(rows.select(
        F.col("model").cast("int").alias("model"), "part", F.col(f"`{label}`").cast("double").alias("y"),
        F.array(*[bins.column(c) for c in names]).alias("bins"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept") if keep else F.lit(None).alias("kept"),
        F.monotonically_increasing_id().alias("row")), "boost-rows")
    cores = spark.sparkContext.defaultParallelism
    if state.rdd.getNumPartitions() < cores:  # a small table was written by few tasks; a model's rows together sum up to fewer bins
        state = state.repartition(cores, "model")
    own = (F.col("part") == "train") & F.col("y").isNotNull() & ~F.isnan("y")
    start = {r["model"]: r for r in state.filter(own).groupBy("model").agg(F.avg("y").alias("mean"), F.percentile_approx("y", 0.5, 10000).alias("median"),
                                                                           F.min("y").alias("least"), F.count(F.lit(1)).alias("n")).collect()}
    for m, r in start.items():
        if params[m].loss == "tweedie" and (r["least"] < 0 or r["mean"] <= 0):
            raise ValueError(f"model {m}: Tweedie needs labels from 0 on, not all 0")
    base = {m: _start(params[m], r) for m, r in start.items()}
    shift = F.element_at(_literal([base.get(m, 0.0) for m in range(count)], "double"), F.col("model") + 1)
    # rows that can't be trained on are marked so; a model without any train rows has no predictions
    state = state.filter(F.col("model").isin(*base)) if base else state.filter(F.lit(False))
    state = state.withColumns({"f": shift, "best": shift, "part": F.when((F.col("part") == "train") & ~own, "none").otherwise(F.col("part"))})
    state = _Rows(state)
    active, best, lowest = sorted(base), {m: 0 for m in base}, {}
    tree_rows = [(m, 0, 1, None, None, None, None, None, None, start[m]["n"], base[m]) for m in sorted(base)]
    error_rows: list[tuple] = []
    done: list[DataFrame] = []
    last = dict(best)
    round_ = 0
    while active and round_ < max(params[m].rounds for m in active):
        if round_ == 0:
            errors = _errors(state, active, params)
            _note(error_rows, lowest, best, 0, errors, choose_by, active)
            for stopper in stoppers:  # round 0 is the constant model
                stopper(0, {k: e for k, (_, e) in errors.items()}, active)
        round_ += 1
        trees, grown = _grow(state, active, params, names, bins, round_, count, tree_rows)
        moved = state.sql(_move(trees, max(params[m].max_depth for m in active), [m for m in active if best[m] == round_ - 1]))
        if round_ % CUT == 0:
            gone = [m for m in base if m not in active and last[m] > round_ - CUT - 1]
            if gone:  # rows of models that stopped since the last cut are written away
                done.append(materialize(_ended(state.df.filter(F.col("model").isin(gone)), best, last, count), "boost-done"))
            moved = materialize(moved.filter(F.col("model").isin(*active)), "boost-state")
        moved = _Rows(moved)
        errors = _errors(moved, active, params)  # fills the cache
        state.drop()
        state = moved
        _note(error_rows, lowest, best, round_, errors, choose_by, active)
        last.update({m: round_ for m in active})
        seen = {k: e for k, (_, e) in errors.items()}
        stopped = set().union(*[s(round_, seen, active) for s in stoppers], (m for m in active if params[m].rounds <= round_),
                              (m for m in active if m not in grown and params[m].rows_share >= 1 and params[m].features_share >= 1))
        active = [m for m in active if m not in stopped]
    ended = materialize(_ended(state.df, best, last, count), "boost-done")
    state.drop()
    for piece in done:
        ended = ended.unionByName(piece)
    out = ended.select("model", F.when(F.col("part") == "none", "train").otherwise(F.col("part")).alias("part"), F.col("y").alias(label),
                       *[F.col("kept")[c].alias(c) for c in keep], F.expr(_response(params, sorted(base), "best")).alias("preds"))
    kept = spark.createDataFrame(sorted(best.items()), "model int, best int")
    trees = spark.createDataFrame(tree_rows, TREE_SCHEMA).join(kept, "model").filter("round <= best").drop("best")
    return Boosted(trees, spark.createDataFrame(error_rows, ERROR_SCHEMA), out, bins, list(params), base, best)


class _Rows:
    """The cached state of the rows under a view of its own; dropping a view drops what is cached for it."""

    def __init__(self, df: DataFrame):
        self.df, self.name = df.persist(), f"boost_rows_{uuid.uuid4().hex}"
        self.df.createOrReplaceTempView(self.name)

    def sql(self, text: str) -> DataFrame:
        return self.df.sparkSession.sql(text.replace("{state}", self.name))

    def drop(self) -> None:
        self.df.sparkSession.catalog.dropTempView(self.name)
        self.df.unpersist()


def _start(p: BoostParams, r) -> float:
    return r["median"] if p.loss == "absolute" else math.log(r["mean"]) if p.loss == "tweedie" else r["mean"]


def _response(params: Sequence[BoostParams], models: Sequence[int], score: str) -> str:
    """SQL of the prediction that belongs to a score."""
    return _case(models, params, lambda p: f"exp({score})" if p.loss == "tweedie" else score) if models else score


def _errors(state: _Rows, active: Sequence[int], params: Sequence[BoostParams]) -> dict[tuple[int, str], tuple[int, float]]:
    """(model, part) -> number of rows and mean absolute error."""
    sql = f"""SELECT model, part, count(*) AS n, avg(abs(y - {_response(params, active, 'f')})) AS e FROM {{state}}
              WHERE model IN ({', '.join(map(str, active))}) AND part <> 'none' AND y IS NOT NULL AND NOT isnan(y) GROUP BY model, part"""
    return {(r["model"], r["part"]): (r["n"], r["e"]) for r in state.sql(sql).collect()}


def _note(rows: list[tuple], lowest: dict, best: dict, round_: int, errors: Mapping, choose_by: str, active: Sequence[int]) -> None:
    rows += [(m, round_, part, n, e) for (m, part), (n, e) in sorted(errors.items())]
    for m in active:
        e = errors.get((m, choose_by), (0, None))[1]
        if e is None or m not in lowest or e < lowest[m]:
            best[m] = round_
            if e is not None:
                lowest[m] = e


def _ended(state: DataFrame, best: Mapping[int, int], last: Mapping[int, int], count: int) -> DataFrame:
    """Rows of models that train no more: ``best`` holds the score of the best round."""
    same = _literal([int(best.get(m, 0) == last.get(m, 0)) for m in range(count)], "int")
    return state.select("model", "row", "part", "y", "kept", F.when(F.element_at(same, F.col("model") + 1) == 1, F.col("f")).otherwise(F.col("best")).alias("best"))


def _move(trees: _Trees, depth: int, improved: Sequence[int]) -> str:
    """SQL of the rows after a round: each score moves by its leaf; the score of a best round is remembered."""
    best = f"CASE WHEN model IN ({', '.join(map(str, improved))}) THEN f ELSE best END" if improved else "best"
    leaf = f"element_at({_array_sql(trees.value, 'double')}, model * {trees.width} + node + 1)"
    return f"SELECT * EXCEPT (node, f, best), f + {leaf} AS f, {best} AS best FROM ({trees.down('{state}', depth)})"


def _grow(state: _Rows, active: Sequence[int], params: Sequence[BoostParams], names: Sequence[str], bins: Bins, round_: int, count: int,
          rows: list[tuple]) -> tuple[_Trees, set[int]]:
    """One tree of every active model; returns the trees and the models whose tree has a split."""
    trees, grown = _Trees(count, max(params[m].max_depth for m in active)), set()
    leaves: dict[tuple[int, int], tuple[float, int]] = {}
    open_: dict[int, set[int]] = {m: {1} for m in active}

    def value(m: int, g: float, h: float) -> float:
        p = params[m]
        return -p.learning_rate * g / (h + p.l2) if h + p.l2 else 0.0

    for level in range(max(params[m].max_depth for m in active)):
        todo = [m for m in active if params[m].max_depth > level and open_[m]]
        if not todo:
            break
        found: dict[int, set[int]] = {m: set() for m in active}
        for r in state.sql(_level(todo, params, trees, level, round_, len(names))).collect():
            m, node, own, split = r["model"], r["node"], r["own"], r["best"]
            if level == 0:
                leaves[m, 1] = (value(m, own["tg"], own["th"]), own["tn"])
            if split is None:
                continue
            feature, bin_ = names[-split["f"]], -split["b"]
            trees.split[trees.at(m, node)] = (-split["f"] << 8) | (bin_ << 1) | int(split["to_left"])
            mine, n = leaves.pop((m, node))
            rows.append((m, round_, node, feature, *bins.threshold(feature, bin_), bin_, split["to_left"], split["gain"], n, mine))
            leaves[m, 2 * node] = (value(m, split["lg"], split["lh"]), split["ln"])
            leaves[m, 2 * node + 1] = (value(m, own["tg"] - split["lg"], own["th"] - split["lh"]), n - split["ln"])
            found[m] |= {2 * node, 2 * node + 1}
            grown.add(m)
        open_ = found
    medians = [m for m in active if params[m].loss == "absolute"]
    if medians:
        train = f"(SELECT model, bins, y, f FROM {{state}} WHERE part = 'train' AND model IN ({', '.join(map(str, medians))}))"
        sql = f"SELECT model, node, percentile_approx(y - f, 0.5D, 10000) AS v FROM ({trees.down(train, max(params[m].max_depth for m in medians))}) GROUP BY model, node"
        for r in state.sql(sql).collect():
            m, node = r["model"], r["node"]
            if (m, node) in leaves:
                leaves[m, node] = (params[m].learning_rate * r["v"], leaves[m, node][1])
    for (m, node), (v, n) in sorted(leaves.items()):
        trees.value[trees.at(m, node)] = v
        rows.append((m, round_, node, None, None, None, None, None, None, n, v))
    return trees, grown


def predict(fitted: Boosted, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``model``) and ``preds``: all kept trees of the row's model, as one expression.

    Trees are constants of the plan: models x kept rounds x 2 ** depth numbers. Rows of a model that was not trained get NULL.
    """
    params, names = fitted.params, fitted.bins.features
    depth, rounds = max(p.max_depth for p in params), max(fitted.best.values(), default=0)
    width = 2 ** (depth + 1)
    place = {name: i for i, name in enumerate(names)}
    size = max(1, rounds) * width
    split, leaf = [-1] * (len(params) * size), [0.0] * (len(params) * size)
    for r in fitted.trees.filter("round > 0").collect():
        at = r["model"] * size + (r["round"] - 1) * width + r["node"]
        if r["feature"] is None:
            leaf[at] = r["value"]
        else:
            split[at] = (place[r["feature"]] << 8) | (r["bin"] << 1) | int(r["missing_left"])
    known = sorted(fitted.base)
    shift = [fitted.base.get(m, math.nan) for m in range(len(params))]
    go = "transform(array(element_at({splits}, {at} + node + 1)), c -> CASE WHEN c < 0 THEN node WHEN CASE WHEN element_at(_bins, shiftright(c, 8) + 1) = 0 " \
         "THEN c & 1 = 1 ELSE element_at(_bins, shiftright(c, 8) + 1) <= (shiftright(c, 1) & 127) END THEN 2 * node ELSE 2 * node + 1 END)[0]"
    at = f"(model * {size} + t * {width})"
    step = go.format(splits="_splits", at=at)
    node = f"aggregate(sequence(1, {depth}), 1, (node, i) -> {step})"
    score = f"element_at(_start, model + 1) + aggregate(sequence(0, {max(1, rounds) - 1}), 0D, (s, t) -> s + element_at(_leaves, {at} + {node} + 1))"
    plan = rows.withColumns({"_bins": F.array(*[fitted.bins.column(c) for c in names]), "_splits": _literal(split, "int"), "_leaves": _literal(leaf, "double"),
                             "_start": F.expr(f"cast(split('{','.join(map(repr, shift))}', ',') as array<double>)")})
    scored = plan.withColumn("_score", F.expr(score))
    value = F.when(F.col("model").isin(*known), F.expr(_response(params, known, "_score"))) if known else F.lit(None).cast("double")
    return scored.select(*rows.columns, value.alias("preds"))


def gain_totals(trees: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Total gain, splits and rows split per feature (M7)."""
    return trees.filter(F.col("feature").isNotNull()).groupBy(*keys, "feature").agg(
        F.sum("gain").alias("gain"), F.count(F.lit(1)).cast("long").alias("n_splits"), F.sum("n_rows").cast("long").alias("n_rows"))


def stopping_rounds(errors: DataFrame, keys: Sequence[str], patience: int, round_col: str = "round", error_col: str = "error") -> DataFrame:
    """Per group of a table of round errors, the round that training with ``patience`` keeps and the one at which it stops (M3).

    ``best_round`` is the first round of the lowest error before the stop; ``stop_round`` the first round that lies
    ``patience`` rounds after the best so far, or the last one. Groups have one row per round; NULL errors never improve.
    """
    w = Window.partitionBy(*keys).orderBy(round_col)
    r, e = F.col(round_col), F.col(error_col)
    before = F.min(error_col).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = errors.withColumn("_new", e.isNotNull() & (before.isNull() | (e < before)))
    seen = seen.withColumn("_best", F.max(F.when(F.col("_new"), r)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = F.coalesce(F.min(F.when(r - F.col("_best") >= patience, r)), F.max(r))
    stop = seen.groupBy(*keys).agg(ends.alias("stop_round"), F.max(F.struct(r, "_best")).alias("_last"),
                                   F.min(F.when(r - F.col("_best") >= patience, F.struct(r, "_best"))).alias("_at"))
    return stop.select(*keys, F.coalesce(F.col("_at._best"), F.col("_last._best")).alias("best_round"), "stop_round")


def halving_survivors(scores: DataFrame, rungs: int, eta: int = 2, candidate: str = "candidate", rung: str = "rung", error: str = "error") -> DataFrame:
    """Successive halving over a table of errors, one row per (candidate, fold, rung): rung, candidate, mean_error, place, survives (M6).

    Rung r ranks the survivors of rung r - 1 by mean error, ties by candidate, and keeps the best 1 / ``eta``, rounded up.
    The windows hold one row per candidate.
    """
    out, alive = [], None
    for k in range(rungs):
        now = scores.filter(F.col(rung) == k)
        if alive is not None:
            now = now.join(alive, candidate, "left_semi")
        means = now.groupBy(candidate).agg(F.avg(error).alias("mean_error"))
        everyone = Window.partitionBy(F.lit(k))
        place = F.row_number().over(everyone.orderBy("mean_error", candidate))
        means = means.select(F.lit(k).alias("rung"), candidate, "mean_error", place.cast("int").alias("place"),
                             (place <= F.ceil(F.count(F.lit(1)).over(everyone) / F.lit(eta))).alias("survives"))
        out.append(means)
        alive = means.filter("survives").select(candidate)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole
