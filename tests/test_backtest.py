"""Folds and fold membership (T1-T4), scores."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import aggregate as agg
from hourgrid.plans import backtest as bt


def _hours(spark, start, days):
    rows = [(start + dt.timedelta(hours=h),) for h in range(days * 24)]
    return spark.createDataFrame(rows, "datetime timestamp_ntz")


def test_month_folds_clamp_month_end(spark):
    df = _hours(spark, dt.datetime(2023, 1, 31), 2)
    f = bt.month_folds(df, "datetime", train_range=1, test_range=1, shift=1, splits=2).orderBy("fold").collect()
    assert f[0]["train_end"] == dt.datetime(2023, 2, 27, 23)
    assert f[0]["test_start"] == dt.datetime(2023, 2, 28)
    assert f[0]["test_end"] == dt.datetime(2023, 3, 30, 23)
    assert f[1]["train_start"] == dt.datetime(2023, 1, 31)     # expanding: start never moves
    assert f[1]["train_end"] == dt.datetime(2023, 3, 30, 23)


def test_share_folds_reject_shares(spark):
    df = _hours(spark, dt.datetime(2023, 1, 1), 3)
    with pytest.raises(ValueError):
        bt.share_folds(df, "datetime", train_share=0.8, val_share=0.2)


def _expected_share_folds(days, start, tr, va, nv, nt, fh, expanding):
    """Expected bounds, computed with pandas durations from the stated rules."""
    d0 = pd.Timestamp(start)
    test_end = d0 + pd.Timedelta(days=days - 1) + pd.Timedelta(hours=23)
    total = pd.Timedelta(days=days)
    train_range = (total * tr).ceil("D")
    val_start = d0 + train_range
    val_range = (total * va).ceil("D")
    val_end = val_start + val_range - pd.Timedelta(hours=1)
    test_start = val_start + val_range
    test_range = test_end - test_start + pd.Timedelta(hours=1)
    vstep = (val_range / nv).ceil("D")
    tstep = (test_range / nt).ceil("D")
    span = pd.Timedelta(days=fh - 1, hours=23)
    out = []
    for i in range(nv):
        out.append(("val", i, d0 + (not expanding) * i * vstep, d0 + train_range - pd.Timedelta(hours=1) + i * vstep,
                    val_start + i * vstep, val_start + i * vstep + span))
    for i in range(nt):
        out.append(("test", i, d0 + int(not expanding) * (val_range + i * tstep), val_end + i * tstep,
                    test_start + i * tstep, test_start + i * tstep + span))
    return sorted((k, i, *[x.to_pydatetime() for x in b]) for k, i, *b in out)


@pytest.mark.parametrize("days,expanding", [(100, False), (61, True), (30, False)])
def test_share_folds_match_rules(spark, days, expanding):
    start = dt.datetime(2022, 5, 1)
    df = _hours(spark, start, days)
    got = bt.share_folds(df, "datetime", 0.64, 0.16, 3, 3, fh=7, expanding=expanding).collect()
    got = sorted((r["kind"], r["fold"], r["train_start"], r["train_end"], r["test_start"], r["test_end"]) for r in got)
    assert got == _expected_share_folds(days, start, 0.64, 0.16, 3, 3, 7, expanding)


def test_assign_folds_parts(spark):
    df = _hours(spark, dt.datetime(2023, 1, 1), 10).withColumn("target", F.lit(1.0))
    folds = spark.createDataFrame(
        [("test", 0, dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 6, 23), dt.datetime(2023, 1, 7),
          dt.datetime(2023, 1, 8, 23))],
        "kind string, fold int, train_start timestamp_ntz, train_end timestamp_ntz, test_start timestamp_ntz, "
        "test_end timestamp_ntz")
    out = bt.assign_folds(df, folds, "datetime", eval_days=2)
    counts = {r["part"]: r["count"] for r in out.groupBy("part").count().collect()}
    # eval runs from midnight of the last train day minus 2 days: Jan 4, 5 and 6
    assert counts == {"train": 24 * 3, "eval": 24 * 3, "test": 24 * 2}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_sample_holdout_is_partitioning_independent(spark):
    df = _hours(spark, dt.datetime(2023, 1, 1), 20)
    a = {r[0] for r in bt.sample_holdout(df.repartition(1), 50, ["datetime"]).collect()}
    b = {r[0] for r in bt.sample_holdout(df.repartition(9), 50, ["datetime"]).collect()}
    assert a == b and len(a) == 50
    assert bt.sample_holdout(df, 10_000, ["datetime"]).count() == 480   # min(n, rows)


def test_scores_and_ratio(spark):
    pred = spark.createDataFrame(
        [("f", "train", 1.0, 2.0), ("f", "train", 3.0, 3.0), ("f", "test", 0.0, 4.0), ("f", "test", None, 1.0)],
        "fold string, part string, target double, preds double")
    sc = bt.fold_scores(pred, ["fold", "part"])
    got = {r["part"]: (r["mae"], r["n_scored"]) for r in sc.collect()}
    assert got == {"train": (0.5, 2), "test": (4.0, 1)}
    r = agg.train_test_ratio(sc, ["fold"]).collect()[0]
    assert r["ratio"] == 0.125
    p = agg.error_percentiles(pred.filter("target is not null"), [], "target", "preds").collect()[0]
    # errors 1, 0, 4 -> linear percentiles
    assert math.isclose(p["p50"], 1.0) and math.isclose(p["p60"], 1.6) and math.isclose(p["p75"], 2.5)


def test_exact_percentiles_match_numpy_on_skewed_groups(spark):
    import numpy as np

    from hourgrid.operators.aggregate import exact_percentiles

    rng = np.random.default_rng(7)
    hot = rng.exponential(3.0, 3000).round(3)
    rows = [("hot", float(x)) for x in hot] + [("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", None)]
    rows += [("hot", float(x)) for x in hot[:50]]          # duplicated values
    df = spark.createDataFrame(rows, "g string, x double")
    out = {r["g"]: r for r in exact_percentiles(df, ["g"], "x", [0.5, 0.6, 0.75, 0.0, 1.0], buckets=7).collect()}
    fast = {r["g"]: r for r in exact_percentiles(df, ["g"], "x", [0.5, 0.6, 0.75, 0.0, 1.0]).collect()}
    assert {g: r.asDict() for g, r in fast.items()} == {g: r.asDict() for g, r in out.items()}
    allhot = np.concatenate([hot, hot[:50]])
    for q in (0.5, 0.6, 0.75, 0.0, 1.0):
        assert math.isclose(out["hot"][f"p{int(q * 100)}"], float(np.percentile(allhot, q * 100)), abs_tol=1e-9)
    assert out["a"]["p50"] == 1.5 and out["b"]["p75"] == 5.0
    assert out["c"]["p50"] is None
    glob = exact_percentiles(df, [], "x", [0.5], buckets=3).collect()[0]
    allv = np.array([x for _, x in rows if x is not None])
    assert math.isclose(glob["p50"], float(np.percentile(allv, 50)))


def test_discrete_percentiles_match_percentile_disc(spark):
    import random

    from hourgrid.operators.aggregate import exact_percentiles

    rnd = random.Random(3)
    for n in (1, 2, 3, 4, 5, 10, 11, 100):
        df = spark.createDataFrame([(rnd.randint(0, 50),) for _ in range(n)], "x int")
        qs = [0.0, 0.25, 0.5, 0.75, 1.0]
        got = exact_percentiles(df, [], "x", qs, buckets=3, discrete=True).first()
        fast = exact_percentiles(df, [], "x", qs, discrete=True).first()
        assert got.asDict() == fast.asDict()
        for q in qs:
            want = df.selectExpr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY x)").first()[0]
            assert float(got[f"p{int(q * 100)}"]) == float(want), (n, q)


def test_library_trees_give_importances(spark):
    rows = [(i, float(i % 10), float(i % 3), 2.0 * (i % 10), "test" if i % 4 == 0 else "train") for i in range(200)]
    df = spark.createDataFrame(rows, "i int, a double, b double, target double, part string")
    model, pred, names = bt.fit_predict(df.filter("part = 'train'"), df.filter("part = 'test'"), bt.FitSpec("gbt", "gbt", {"maxIter": 2}), "target", ["a", "b"], [], use_eval=False)
    got = dict(bt.feature_importances(model, names))
    assert set(got) == {"a", "b"} and abs(sum(got.values()) - 1) < 1e-9 and got["a"] > 0.9 and pred.count() == 50


def test_a_training_task_scans_a_bounded_number_of_rows(spark):
    from hourgrid.session import materialize

    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    feats = materialize(spark.range(200_000).select("id", F.rand(1).alias("x")).coalesce(1), "bounded", options={"parquet.block.size": 1 << 16})
    most = lambda: max(r["count"] for r in feats.groupBy(F.spark_partition_id()).count().collect())
    whole = most()
    with bt._task_rows(feats, 20_000):
        assert most() <= 40_000 < whole
    assert spark.conf.get(name) == old and most() == whole
    with bt._task_rows(feats.limit(0), 20_000):
        assert spark.conf.get(name) == old


def _tree_rows(spark, n, parts):
    df = spark.range(0, n, 1, parts).select(F.col("id").cast("double").alias("d"), F.rand(1).alias("a"), F.floor(F.rand(2) * 5).cast("double").alias("b"),
                                            F.when(F.rand(3) < 0.3, 0.0).otherwise(F.randn(4) * 50).alias("c"), F.lit(3.0).alias("same"))
    y = F.col("a") * F.col("b") + F.sin("c") * 3 + F.rand(5) + F.when(F.col("d") > n / 2, 1.0).otherwise(0.0)
    return df.withColumns({"target": y, "part": F.lit("train")}).localCheckpoint()


def test_block_trees_are_those_of_the_library(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from hourgrid.plans import block_trees as trees

    names, params = ["d", "a", "b", "c", "same"], {"maxIter": 4, "maxDepth": 4}
    for n, parts, exact in ((40, 1, 65_536), (12_000, 3, 65_536), (12_000, 3, 500), (12_000, 3, 0)):
        monkeypatch.setattr(trees, "EXACT_ROWS", exact)
        monkeypatch.setattr(trees, "EXACT_FIT", exact)
        monkeypatch.setattr(trees, "GATHER", 64 if exact else 1)
        df = _tree_rows(spark, n, parts)
        x = VectorAssembler(inputCols=names, outputCol="_features").transform(df)
        own = trees.fit_blocks(df, names, "target", n, params)
        lib = GBTRegressor(featuresCol="_features", labelCol="target", predictionCol="lib", seed=10, **params).fit(x)
        both = own.transform(lib.transform(x)).select("lib", "preds").toArrow()
        assert np.allclose(both["lib"].to_numpy(), both["preds"].to_numpy(), rtol=1e-9, atol=1e-9), (n, exact)
        assert np.allclose(own.featureImportances.toArray(), lib.featureImportances.toArray(), rtol=1e-6)


def test_a_fit_keeps_few_bytes_a_row(spark, monkeypatch):
    from hourgrid.plans import block_trees as trees

    n, most, plain = 40_000, [], trees._Growth.tree

    def watched(self, *args):
        out = plain(self, *args)
        most.append(sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()))
        return out

    df, names = _tree_rows(spark, n, 2), ["d", "a", "b", "c"]
    held = sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    monkeypatch.setattr(trees._Growth, "tree", watched)
    model, pred, _ = bt.fit_predict(df, df.limit(10), bt.FitSpec("gbt", "gbt", {"maxIter": 3, "maxDepth": 2}), "target", names, [], use_eval=False)
    assert len(most) == 3 and max(most) - held < 60 * n and pred.count() == 10
    assert sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()) <= held


def test_block_trees_of_rows_without_a_split(spark):
    from hourgrid.plans import block_trees as trees

    df = spark.createDataFrame([(1.0, float(i)) for i in range(4)], "a double, y double").selectExpr("a", "y")
    assert trees.fit_blocks(df, ["a"], "y", 4, {"maxIter": 2}).trees[0].values.tolist() == [1.5]
    same = df.selectExpr("y AS a", "2D AS y")
    assert trees.fit_blocks(same, ["a"], "y", 4, {"maxIter": 2}).trees[0].values.tolist() == [2.0]
    with pytest.raises(Exception, match="missing"):
        trees.fit_blocks(df.selectExpr("a", "CASE WHEN y > 1 THEN y END AS y"), ["a"], "y", 4)
    assert not trees.fits_blocks({"lossType": "absolute"}) and not trees.fits_blocks({"subsamplingRate": 0.5}) and trees.fits_blocks(None)
