"""Boosting by aggregates: trees from the definition, losses, patience, halving, missing values, sampling."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hourgrid.plans import boosting as B

SCHEMA = "model int, part string, target double, a double, b double, c string, id int"


def brute_tree(rows, depth, min_rows, edges):
    """One squared-loss tree by trying every split: {node: (feature, bin, missing_left, n)} and {leaf: (mean, n)}."""
    base = sum(r["y"] for r in rows) / len(rows)
    splits, leaves = {}, {}

    def grow(node, rows, level):
        g = [base - r["y"] for r in rows]
        total, n, gg = sum(g), len(rows), sum(x * x for x in g)
        best = None
        if level < depth and gg:
            for f, name in enumerate(edges):
                for bin_ in sorted({r[name] for r in rows} - {0}):
                    for left in (True, False):
                        side = [x for x, r in zip(g, rows) if (left if r[name] == 0 else r[name] <= bin_)]
                        k, s = len(side), sum(side)
                        if min(k, n - k) < max(1, min_rows):
                            continue
                        share = round((s * s / k + (total - s) ** 2 / (n - k) - total * total / n) / gg, 9)
                        if share > 0 and (best is None or (share, -f, -bin_, left) > best[0]):
                            best = ((share, -f, -bin_, left), name, bin_, left)
        if best is None:
            leaves[node] = (-total / n, n)
            return
        _, name, bin_, left = best
        splits[node] = (name, bin_, left, n)
        to_left = [(left if r[name] == 0 else r[name] <= bin_) for r in rows]
        grow(2 * node, [r for r, x in zip(rows, to_left) if x], level + 1)
        grow(2 * node + 1, [r for r, x in zip(rows, to_left) if not x], level + 1)

    grow(1, rows, 0)
    return splits, leaves


def data(n=240, models=1):
    rows = []
    for i in range(n):
        k = i * 2654435761 % 2**32 >> 8  # spread, so that parts and features are unrelated
        a = None if k % 11 == 0 else float(k // 16 % 10)
        b = float("nan") if k % 13 == 0 else float(k // 256 % 6)
        c = None if k % 17 == 0 else "xyz"[k // 2048 % 3]
        y = (a if a is not None else 12.0) * 2 + (3 if c == "y" else 0) + (i * 31 % 7) / 10
        part = "test" if i % 6 == 0 else "eval" if i % 6 == 1 else "train"
        rows += [(m, part, y, a, b, c, i) for m in range(models)]
    return rows


def test_one_tree_equals_every_split_tried(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    fit = B.boost(df, [B.BoostParams(rounds=1, learning_rate=1.0, max_depth=3, min_rows=5)], ["a", "b", "c"], choose_by="none", keep=["id"])
    own = [r for r in rows if r[1] == "train"]
    values = {f: sorted({r[k] for r in own if r[k] is not None and r[k] == r[k]}) for f, k in (("a", 3), ("b", 4), ("c", 5))}
    coded = [{"y": y, **{f: (0 if v is None or v != v else values[f].index(v) + 1) for f, v in (("a", a), ("b", b), ("c", c))}}
             for _, _, y, a, b, c, _ in own]
    splits, leaves = brute_tree(coded, 3, 5, ["a", "b", "c"])
    got = fit.trees.filter("round = 1").collect()
    assert {r.node: (r.feature, r.bin, r.missing_left, r.n_rows) for r in got if r.feature} == splits
    assert {r.node: (round(r.value, 9), r.n_rows) for r in got if not r.feature} == {k: (round(v, 9), n) for k, (v, n) in leaves.items()}
    # thresholds are values of the features
    for r in got:
        if r.feature:
            top = r.feature != "c" and r.bin == len(values[r.feature])
            assert (r.threshold_text if r.feature == "c" else r.threshold) == (math.inf if top else values[r.feature][r.bin - 1])
    preds = {r.id: r.preds for r in fit.predictions.collect()}
    again = {r.id: r.preds for r in B.predict(fit, df).collect()}
    assert len(preds) == len(again) == 240 and all(abs(preds[k] - again[k]) < 1e-9 for k in preds)


@pytest.fixture(scope="module")
def losses(spark):
    forms = ("squared", "absolute", "huber", "tweedie")
    df = spark.createDataFrame(data(600, 4), SCHEMA)
    params = [B.BoostParams(loss=f, rounds=12, learning_rate=0.3, max_depth=3, min_rows=5, alpha=2.0) for f in forms]
    return df, B.boost(df, params, ["a", "b", "c"], keep=["id"])


def test_every_loss_learns(losses):
    _, fit = losses
    errors = defaultdict(dict)
    for r in fit.errors.filter("part = 'eval'").collect():
        errors[r.model][r.round] = r.error
    for m, by in errors.items():
        assert by[12] < 0.55 * by[0], (m, by)
    assert set(errors) == {0, 1, 2, 3}


def test_kept_round_is_the_best_and_predictions_follow(losses):
    df, fit = losses
    scored = fit.predictions.filter("part = 'eval'").groupBy("model").agg(F.avg(F.abs(F.col("target") - F.col("preds"))).alias("e")).collect()
    low = {r.model: r.e for r in fit.errors.filter("part = 'eval'").groupBy("model").agg(F.min("error").alias("e")).collect()}
    for r in scored:
        assert abs(r.e - low[r.model]) < 1e-9
    a = {(r.model, r.id): r.preds for r in fit.predictions.collect()}
    b = {(r.model, r.id): r.preds for r in B.predict(fit, df).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_models_grown_together_equal_models_grown_alone(spark, losses):
    _, fit = losses
    alone = B.boost(spark.createDataFrame([(0, *r[1:]) for r in data(600)], SCHEMA), [fit.params[0]], ["a", "b", "c"], keep=["id"])
    want = sorted((r.round, r.node, r.feature or "", r.bin or 0) for r in fit.trees.filter("model = 0").collect())
    assert sorted((r.round, r.node, r.feature or "", r.bin or 0) for r in alone.trees.collect()) == want


def test_training_goes_on_past_a_plateau(spark):
    """Errors that stand still for fewer rounds than the patience do not end training; as many do."""
    errors = [5.0, 4.0, 4.0, 4.0, 4.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0]
    for patience, (best, stop) in {3: (1, 4), 5: (5, 10)}.items():
        rule = B.Patience(patience)
        ended = next((r for r, e in enumerate(errors) if rule(r, {(0, "eval"): e}, [0])), len(errors) - 1)
        assert (rule.best[0][1], ended) == (best, stop)
        table = spark.createDataFrame([("m", r, e) for r, e in enumerate(errors)], "k string, round int, error double")
        row = B.stopping_rounds(table, ["k"], patience).first()
        assert (row.best_round, row.stop_round) == (best, stop)


def test_patience_stops_models_on_their_own(spark):
    rows = data(300, 2)
    mean = sum(r[2] for r in rows if r[1] == "train") / sum(r[1] == "train" for r in rows)
    rows = [(m, p, y if m == 0 or p == "train" else 2 * mean - y, a, b, c, i) for m, p, y, a, b, c, i in rows]  # model 1 only gets worse on eval
    params = [B.BoostParams(rounds=10, learning_rate=0.2, max_depth=2, min_rows=5)] * 2
    fit = B.boost(spark.createDataFrame(rows, SCHEMA), params, ["a", "b", "c"], stoppers=[B.Patience(3)], keep=["id"])
    last = {r.model: r["last"] for r in fit.errors.groupBy("model").agg(F.max("round").alias("last")).collect()}
    assert last[0] == 10 and last[1] < 10 and fit.best[1] + 3 == last[1]
    assert fit.predictions.count() == 600 and fit.predictions.filter("preds IS NULL").count() == 0
    again = {(r.model, r.id): r.preds for r in B.predict(fit, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(abs(again[r.model, r.id] - r.preds) < 1e-9 for r in fit.predictions.collect())


def test_halving_drops_the_worst_and_fits_no_one_twice(spark):
    rates = [0.3, 0.001, 0.2, 0.002]
    params = [B.BoostParams(rounds=8, learning_rate=r, max_depth=2, min_rows=5) for r in rates for _ in range(2)]
    rows = [(m, *r[1:]) for m in range(8) for r in data(200)]
    rule = B.Halving({m: m // 2 for m in range(8)}, first=2)
    fit = B.boost(spark.createDataFrame(rows, SCHEMA), params, ["a", "b", "c"], stoppers=[rule])
    assert [(r, n, c, s) for r, n, c, _, s in rule.rungs] == [(0, 2, 0, True), (0, 2, 2, True), (0, 2, 3, False), (0, 2, 1, False), (1, 4, 0, True), (1, 4, 2, False)]
    assert rule.winner() == 0
    rounds = {r.model: r.n for r in fit.errors.filter("part = 'eval'").groupBy("model").agg(F.max("round").alias("n")).collect()}
    assert rounds == {0: 4, 1: 4, 2: 2, 3: 2, 4: 4, 5: 4, 6: 2, 7: 2}


def test_survivors_of_a_score_table(spark):
    scores = [(c, f, r, c * 1.0 + (10 if r and c == 0 else 0)) for c in range(5) for f in range(2) for r in range(3)]
    got = B.halving_survivors(spark.createDataFrame(scores, "candidate int, fold int, rung int, error double"), 3).collect()
    assert {(r.rung, r.candidate): r.survives for r in got} == {
        (0, 0): True, (0, 1): True, (0, 2): True, (0, 3): False, (0, 4): False, (1, 0): False, (1, 1): True, (1, 2): True, (2, 1): True, (2, 2): False}


def test_sampling_comes_back_with_the_same_trees(spark):
    p = [B.BoostParams(rounds=3, max_depth=2, min_rows=2, rows_share=0.5, features_share=0.5)]
    df = spark.createDataFrame([r for r in data(300)], SCHEMA)
    runs = [sorted(tuple(r) for r in B.boost(df, p, ["a", "b", "c"]).trees.select("round", "node", "feature", "bin", "n_rows").filter("feature IS NOT NULL").collect())
            for _ in range(2)]
    assert runs[0] == runs[1] and runs[0]


def test_edges(spark):
    p = [B.BoostParams(rounds=3, max_depth=2, min_rows=1)] * 3
    rows = [(0, "train", 1.0, None, 1.0, None, 1), (0, "train", None, 2.0, 1.0, "x", 2), (0, "train", 3.0, 4.0, 1.0, "y", 3), (0, "test", None, None, None, None, 4),
            (1, "test", 1.0, 1.0, 1.0, "x", 5), (2, "train", 2.0, 1.0, 1.0, "x", 6), (2, "test", 5.0, 1.0, 1.0, "x", 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    fit = B.boost(df, p, ["a", "b", "c"], keep=["id"])
    got = {r.id: r.preds for r in fit.predictions.collect()}
    assert set(got) == {1, 2, 3, 4, 6, 7}       # model 1 has no rows to train on
    assert got[7] == got[6] == 2.0 and abs(got[1] - 1.0) < abs(got[1] - 3.0)
    assert {r.id: r.preds for r in B.predict(fit, df).collect()}[5] is None
    empty = B.boost(df.limit(0), p, ["a", "b", "c"], keep=["id"])
    assert empty.predictions.count() == 0 and empty.trees.count() == 0
    with pytest.raises(ValueError):
        B.boost(df.filter("model = 0").withColumn("target", F.lit(-1.0)), [B.BoostParams(loss="tweedie")], ["a"])
    with pytest.raises(ValueError):
        B.BoostParams(loss="quartic")
    with pytest.raises(ValueError):
        B.boost(df, p, ["a", "nothing"])


def test_close_to_the_library_on_squared_loss(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = [(0, "test" if i % 5 == 0 else "train", math.sin(i / 7) * 10 + (i * 13 % 17), float(i % 44), float(i * 13 % 17), "x", i) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA)
    fit = B.boost(df, [B.BoostParams(rounds=12, learning_rate=0.4, max_depth=4, min_rows=1)], ["a", "b"], choose_by="none")
    ours = fit.errors.filter("part = 'test' AND round = 12").first().error
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = GBTRegressor(labelCol="target", maxIter=12, maxDepth=4, stepSize=0.4, seed=1).fit(v.filter("part = 'train'"))
    theirs = model.transform(v.filter("part = 'test'")).agg(F.avg(F.abs(F.col("target") - F.col("prediction")))).first()[0]
    assert ours < 1.05 * theirs


def test_row_filters_stay_out_of_the_levels(spark):
    """The node of a row is computed once per level: expressions do not double with each level."""
    params, trees = [B.BoostParams()], B._Trees(1, 6)
    state = spark.createDataFrame([(0, [1, 2], 1, 1.0, 0.0, "train")], "model int, bins array<tinyint>, row long, y double, f double, part string")
    text = [spark.sql(B._level([0], params, trees, level, 1, 2), state=state)._jdf.queryExecution().executedPlan().toString() for level in (2, 6)]
    assert len(text[1]) < 4 * len(text[0])
