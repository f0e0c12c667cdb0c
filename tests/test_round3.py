"""Rows that joins and splits must keep, contracts without a sort, tables by declared DDL, versions of a table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import joins
from hourgrid.plans import backtest as bt
from hourgrid.plans import report_sql as rsql
from hourgrid.sources import schemas, sinks


@pytest.mark.parametrize("how,want", [("right", 3), ("full", 4), ("left", 2), ("inner", 1)])
def test_dimension_rows_without_a_key_stay(spark, how, want):
    fact = spark.createDataFrame([("a", 1), ("z", 2)], "k string, x int")
    dim = spark.createDataFrame([("a", 10), (None, 20), (None, 30)], "k string, v int")
    out = joins.lookup_join(fact, dim, ["k"], how=how)
    assert out.count() == joins.lookup_join(fact, dim, ["k"], how=how, validate=False).count() == want
    if how == "right":
        assert sorted(r.v for r in out.collect()) == [10, 20, 30]


def test_keys_of_two_columns_one_of_them_null(spark):
    fact = spark.createDataFrame([("a", 1, 5)], "k string, t int, x int")
    dim = spark.createDataFrame([("a", 1, 10), ("a", None, 20), ("a", None, 30)], "k string, t int, v int")
    assert joins.lookup_join(fact, dim, ["k", "t"], how="full").count() == 3
    with pytest.raises(Exception, match="not unique"):
        joins.lookup_join(fact, dim.fillna(1, ["t"]), ["k", "t"]).collect()


def test_the_contract_of_a_numeric_dimension_needs_no_sort(spark):
    dim = spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"), (F.col("id") > 3).alias("b"), F.current_date().alias("d"))
    plan = joins.unique_rows(dim, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    unused = joins.unique_rows(dim.union(dim), ["k"]).select("k")
    with pytest.raises(Exception, match="not unique"):
        unused.collect()


@pytest.mark.parametrize("n", [0, 1, 7, 15, 20, 50])
def test_holdout_of_repeated_keys_has_n_rows(spark, n):
    rows = [("a", 1)] * 10 + [("b", 2)] * 8 + [(None, 3), ("", 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    for parts in (1, 4):
        sample, rest = bt.holdout_split(df.repartition(parts), n, ["k"])
        a, b = Counter(map(tuple, sample.collect())), Counter(map(tuple, rest.collect()))
        assert sum(a.values()) == min(n, 20) and a + b == Counter(rows)
    again, _ = bt.holdout_split(df.repartition(3), n, ["k"])
    assert Counter(map(tuple, again.collect())) == a


def test_holdout_tells_rows_of_one_key_apart(spark):
    rows = [("a", i, {"m": i}) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, v int, m map<string,int>")
    sample, rest = bt.holdout_split(df, 12, ["k"])
    assert sample.count() == 12 and {r.v for r in sample.collect()} | {r.v for r in rest.collect()} == set(range(30))


def test_month_change_keeps_a_small_month_before_a_huge_one(spark):
    df = spark.createDataFrame([("2024-01-05 00:00:00", 1e-9), ("2024-02-05 00:00:00", 1e12), ("2024-03-05 00:00:00", 5e11)], "t string, v double")
    out = rsql.run_report(df.withColumn("t", F.col("t").cast("timestamp_ntz")), rsql.monthly_change("t", "v", "true"))
    got = {r.month.month: r.MoM_diff_pct for r in out.collect()}
    assert out.columns == ["month", "consumption", "MoM_diff", "MoM_diff_pct"] and got[1] is None and got[2] > 1e20 and got[3] == -50.0


@pytest.mark.parametrize("name", ["train", "client", "gas_prices", "electricity_prices"])
def test_declared_ddl_loads_by_name_and_type(spark, name, tmp_path):
    table, path = f"declared_{name}", str(tmp_path / name)
    row = {f.name: ("2024-01-02" if f.dataType.simpleString() == "date" else "2024-01-02 03:00:00" if "timestamp" in f.dataType.simpleString()
                    else "true" if f.dataType.simpleString() == "boolean" else "7") for f in schemas.SCHEMAS[name].fields}
    backwards = spark.createDataFrame([tuple(reversed(row.values()))], ", ".join(f"`{c}` string" for c in reversed(list(row))))
    for _ in range(2):  # a reload replaces
        sinks.load_declared(backwards, name, table, path)
    read = spark.read.table(table)
    assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in schemas.SCHEMAS[name].fields] and read.count() == 1
    with pytest.raises(Exception):
        sinks.load_declared(backwards.drop(next(iter(row))), name, table, path)
    assert read.count() == 1
    spark.sql(f"DROP TABLE {table}")


def test_readers_follow_the_newest_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, path)
    assert sinks.publish_version(spark.range(5), path) == 1
    held = sinks.read_version(spark, path)
    assert sinks.publish_version(held.filter("id > 1").select((F.col("id") * 2).alias("id")), path) == 2
    assert sorted(r.id for r in sinks.read_version(spark, path).collect()) == [4, 6, 8]
    assert held.count() == 5 and sinks.read_version(spark, path, 1).count() == 5
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.publish_version(broken, path)
    assert sorted(r.id for r in sinks.read_version(spark, path).collect()) == [4, 6, 8]
    sinks.publish_version(spark.range(1), path)
    assert sinks.remove_versions(spark, path, keep=2) == 1 and sinks.read_version(spark, path, 2).count() == 3
    with pytest.raises(ValueError):
        sinks.remove_versions(spark, path, keep=0)
    assert sinks.read_version(spark, path).count() == 1


def test_sliced_fold_scores_equal_copied_rows(spark):
    rows = [(i, f"2024-01-{1 + i // 24:02d} {i % 24:02d}:30:00", float(i % 17), float(i % 5) if i % 9 else None, "ab"[i % 2]) for i in range(24 * 28)]
    rows += [(9999, None, 1.0, 1.0, "a")]
    df = spark.createDataFrame(rows, "i int, t string, target double, preds double, k string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    for folds in (bt.share_folds(df, "t", fh=2), bt.share_folds(df, "t", fh=3, expanding=True)):
        for days in (None, 2, 60):
            want = bt.fold_scores(bt.assign_folds(df, folds, "t", days), ["kind", "fold", "k", "part"])
            got = bt.fold_scores_by_slices(df, folds, "t", ["k"], days)
            key = lambda r: (r.kind, r.fold, r.k, r.part)
            a, b = ({key(r): (round(r.mae, 9), r.n_scored) for r in x.collect()} for x in (want, got))
            assert a == b and a
    # rows are not copied: no generator stands between the scan and the sums of the fact
    plan = bt.fold_scores_by_slices(df, folds, "t", ["k"], 2)._jdf.queryExecution().optimizedPlan().toString()
    fact = plan[plan.rindex("Aggregate ["):]
    assert "Generate" not in fact


def test_sketches_merge_within_their_rank_error(spark):
    from hourgrid.operators import aggregate as agg

    df = spark.range(0, 60000, 1, 6).select((F.col("id") % 5).alias("g"), (F.col("id") % 30).alias("day"), ((F.col("id") * 7919) % 60013).cast("double").alias("x"))
    df = df.union(spark.sql("SELECT 7L, 0L, CAST(NULL AS DOUBLE) UNION ALL SELECT 0L, 0L, CAST('NaN' AS DOUBLE)"))
    daily = agg.percentile_sketches(df, ["g", "day"], "x")
    assert daily.agg(F.max(F.length("sketch"))).first()[0] < 8192
    qs = [0.01, 0.5, 0.99]
    weekly = agg.merge_sketches(daily, ["g"])
    off = agg.rank_errors(df, ["g"], "x", agg.sketch_percentiles(weekly, qs), qs).collect()
    assert len(off) == 15 and max(r.rank_error for r in off) < 0.02
    assert sum(r.n for r in weekly.collect()) == 60000
    few = agg.sketch_percentiles(agg.percentile_sketches(df.limit(0), ["g"], "x"), qs)
    assert few.count() == 0


def test_clustered_files_prune_by_series_and_by_time(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "z")
    df = spark.range(0, 64000).select((F.col("id") % 320).alias("s"), F.expr("timestampadd(HOUR, cast(id div 320 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("t"), F.col("id").alias("v"))
    sinks.write_clustered(df, path, "s", "t", files=64)
    files = [pq.read_metadata(f) for f in glob.glob(f"{path}/*.parquet")]

    def stats(meta, column):
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        parts = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        return min(p.min for p in parts), max(p.max for p in parts)

    by_series = sum(not (stats(m, "s")[1] < 10 or stats(m, "s")[0] > 40) for m in files)
    from datetime import datetime
    lo, hi = datetime(2024, 1, 2), datetime(2024, 1, 3)
    by_time = sum(not (stats(m, "t")[1] < lo or stats(m, "t")[0] >= hi) for m in files)
    assert len(files) == 64 and by_series <= 24 and by_time <= 24
    got = sinks.read_clustered(spark, path, "s", (10, 40), "t", "2024-01-02", "2024-01-03")
    assert got.count() == 31 * 24
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(s,10)" in plan and "LessThanOrEqual(s,40)" in plan
    odd = df.select(F.when(F.col("v") % 2 == 0, F.col("s")).alias("s"), F.lit(None).cast("timestamp_ntz").alias("t"), "v")
    sinks.write_clustered(odd, path, "s", "t", files=4)
    assert spark.read.parquet(path).count() == 64000
    sinks.write_clustered(df.limit(0), path, "s", "t")
    assert spark.read.parquet(path).count() == 0


@pytest.mark.parametrize("bins,bucket", [(2, "auto"), (5, None), (32, 3 * 86_400_000_000)])
def test_sliding_median_equals_the_sorted_frame(spark, bins, bucket):
    import random

    from hourgrid.operators import timeseries as ts

    rng = random.Random(bins)
    rows = []
    for g in ("a", "b", None):
        for i in range(220):
            day, hour = rng.randint(1, 28), rng.choice([0, 0, 6, 13])
            x = None if rng.random() < .1 else float("nan") if rng.random() < .05 else float(rng.choice([rng.randint(0, 5), rng.randint(-50, 50)]))
            rows.append((g, None if i == 0 else f"2024-01-{day:02d} {hour:02d}:00:00", x))
    rows += [("c", "2024-01-05 00:00:00", 1.5), ("d", "2024-01-01 00:00:00", None), ("d", "2024-01-02 00:00:00", 2.0)]
    df = spark.createDataFrame(rows, "g string, t string, x double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    clean = df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for w in ("1d", "5d"):
        want = ts.add_rollings(clean, "x", {w: ["median"]}, "t", ["g"], dtype=None)
        got = ts.add_sliding_median(df, "x", w, "t", ["g"], bins=bins, bucket=bucket, dtype=None)
        assert got.columns == want.columns
        name = got.columns[-1]
        key = lambda r: (r.g, r.t, None if r.x != r.x else r.x, None if r[name] is None else round(r[name], 9))
        assert Counter(map(key, got.collect())) == Counter(map(key, want.collect()))
    assert ts.add_sliding_median(df.limit(0), "x", "1d", "t", ["g"]).count() == 0


def test_sliding_median_exchanges_rows_once_and_frames_span_batches(spark):
    from hourgrid.operators import timeseries as ts

    df = spark.range(600).selectExpr("CAST(id % 3 AS int) AS g", "CAST('2024-01-01' AS timestamp_ntz) + make_interval(0, 0, 0, 0, CAST(id div 6 AS int)) AS t",
                                     "CAST((id * 7919) % 101 AS double) AS x")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = ts.add_sliding_median(df, "x", "2d", "t", ["g"], dtype=None)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "count_if" not in plan and plan.count("Window [") == 1
        want = ts.add_rollings(df, "x", {"2d": ["median"]}, "t", ["g"], dtype=None)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
