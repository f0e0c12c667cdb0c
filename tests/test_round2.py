"""Rows that must not be lost or invented: NULL times, NULL keys, duplicate keys, small values, sparse folds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import aggregate, clean, joins, timeseries
from hourgrid.plans import backtest as bt
from hourgrid.plans import features, report_sql, reports


def test_sums_do_not_round_their_inputs(spark):
    df = spark.createDataFrame([("a", 0.004)] * 1000 + [("b", 2e16)], "g string, x double")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(aggregate.total("x").alias("s")).collect()}
    assert abs(got["a"] - 4.0) < 1e-9 and got["b"] == 2e16
    both = df.withColumn("flag", F.lit(True))
    out = {r["g"]: r["total_target"] for r in reports.category_summary(both.filter("g = 'a'"), "g", "flag", "x").collect()}
    sql = {r["g"]: r["total_target"] for r in report_sql.run_report(both.filter("g = 'a'"), report_sql.category("g", "flag", "x")).collect()}
    assert abs(out["a"] - 4.0) < 1e-9 and abs(sql["a"] - 4.0) < 1e-9


@pytest.mark.parametrize("bucket", ["auto", None])
def test_rows_without_a_time_are_kept(spark, bucket):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0), (1, None, 2.0)], "g int, t timestamp_ntz, x double")
    out = timeseries.add_lags_and_rollings(df, "x", {"1d": {"2d": ["mean"]}}, "t", ["g"], bucket=bucket)
    assert out.count() == 2
    assert timeseries.fill_segment(df, "x", "t", ["g"]).count() == 2
    assert timeseries.interpolate_segment(df, "x", "t", ["g"]).count() == 2


def test_null_group_has_percentiles(spark):
    df = spark.createDataFrame([(None, 5.0), (None, 7.0), ("a", 1.0), ("b", None)], "g string, x double")
    got = {r["g"]: r["p50"] for r in aggregate.exact_percentiles(df, ["g"], "x", [0.5]).collect()}
    assert got == {None: 6.0, "a": 1.0, "b": None}


def test_negated_membership_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",)], "k string")
    as_list = {r["k"] for r in clean.semi_filter(df, ["a"], "k", negate=True).collect()}
    as_table = {r["k"] for r in clean.semi_filter(df, keys, "k", negate=True).collect()}
    assert as_list == as_table == {"b", None}


def test_duplicate_dimension_keys_raise(spark):
    fact = spark.createDataFrame([(1, dt.datetime(2024, 1, 3), 5)], "county int, datetime timestamp_ntz, data_block_id int")
    dim = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 5, 1.0, 9.0), (1, dt.datetime(2024, 1, 1), 5, 2.0, 3.0)],
                                "county int, datetime timestamp_ntz, data_block_id int, a double, b double")
    keys = ["county", "datetime", "data_block_id"]
    out = joins.multi_shift_lookup(fact, dim, keys, keys, [("h2d_", {"datetime": "2d"}), ("h1d_", {"datetime": "1d"})])
    with pytest.raises(Exception, match="not unique"):
        out.collect()
    with pytest.raises(Exception, match="not unique"):
        joins.lookup_join(fact, dim, keys).collect()
    assert joins.lookup_join(fact, dim, keys, validate=False).count() == 1
    ok = joins.multi_shift_lookup(fact, dim.limit(1), keys, keys, [("h2d_", {"datetime": "2d"})]).first()
    assert ok["h2d_a"] in (1.0, 2.0)


def test_two_points_of_a_cell_both_count(spark):
    names = [f.name for f in __import__("hourgrid.sources.schemas", fromlist=["x"]).HISTORICAL_WEATHER.fields]
    base = dict.fromkeys(names, 0.0) | {"datetime": dt.datetime(2024, 1, 1), "data_block_id": 1, "longitude": 25.0}
    rows = [base | {"latitude": 58.01, "temperature": 10.0}, base | {"latitude": 58.04, "temperature": 30.0},
            base | {"latitude": 58.04, "temperature": 30.0}]
    from hourgrid.sources import schemas

    hw = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.HISTORICAL_WEATHER)
    out = features.prepare_historical_weather(hw)
    assert sorted(r["temperature"] for r in out.collect()) == [10.0, 30.0]


def test_long_horizons_keep_their_order(spark):
    rows = [(1, dt.datetime(2024, 3, 1), 1, dt.datetime(2024, 1, 1), 1440, 1.0), (1, dt.datetime(2024, 3, 1), 1, dt.datetime(2024, 1, 1, 0, 0, 1), 5, 2.0)]
    df = spark.createDataFrame(rows, "county int, forecast_datetime timestamp_ntz, data_block_id int, origin_datetime timestamp_ntz, hours_ahead int, x double")
    out = timeseries.keep_last(df, ["county", "forecast_datetime", "data_block_id"], ["origin_datetime", "hours_ahead"])
    assert out.first()["x"] == 2.0


def test_fill_has_one_exchange_of_the_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).selectExpr("id % 3 AS g", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS t",
                                         "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS DOUBLE) END AS x")
        plan = timeseries.fill_segment(df, "x", "t", ["g"], bucket_days=3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows, the summary by bucket, the summary by series, and back to the buckets
    assert plan.count("Exchange hashpartitioning") <= 4 and "SinglePartition" not in plan


def test_csv_set_has_the_county_map(spark, tmp_path):
    from hourgrid.sources import readers, schemas

    for name, schema in schemas.SCHEMAS.items():
        (tmp_path / f"{name}.csv").write_text(",".join(f.name for f in reversed(schema.fields)) + "\n")
    (tmp_path / "county_id_to_name_map.json").write_text('{"0": "HARJUMAA", "12": "UNKNOWN"}')
    got = readers.load_csv_tables(spark, str(tmp_path), str(tmp_path))
    assert {r["county"]: r["county_name"] for r in got["county_map"].collect()} == {0: "HARJUMAA", 12: "UNKNOWN"}
    assert all(got[n].schema == s for n, s in schemas.SCHEMAS.items())


@pytest.mark.parametrize("bucket", ["auto", 5 * timeseries.DAY_US])
def test_long_lags_do_not_widen_the_halo(spark, bucket):
    df = spark.range(900).selectExpr("id % 2 AS g", "timestamp_ntz'2022-01-01 00:00:00' + make_dt_interval(CAST(id DIV 2 AS INT)) AS t",
                                     "CASE WHEN id % 11 <> 0 THEN CAST(id AS DOUBLE) END AS x").unionByName(
        spark.createDataFrame([(1, None, 5.0)], "g long, t timestamp_ntz, x double"))
    specs = {"7d": {"14d": ["mean", "count"]}, "364d": {"7d": ["sum"]}, "40d": None}
    got = timeseries.add_lags_and_rollings(df, "x", specs, "t", ["g"], bucket=bucket)
    want = timeseries.add_lags_and_rollings(df, "x", specs, "t", ["g"], bucket=None)
    assert got.columns == want.columns and got.count() == 901
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by (series, instant) and by (series, bucket)
    if bucket == "auto":
        assert f"{4 * 21 * timeseries.DAY_US:.4E}".replace("E+", "E") in plan or str(4 * 21 * timeseries.DAY_US) in plan


def test_fold_cap_is_gone_and_split_is_whole(spark):
    df = spark.range(300).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS t")
    sample, rest = bt.holdout_split(df, 40, ["id"])
    assert sample.count() == 40 and rest.count() == 260 and sample.join(rest, "id").count() == 0
    with pytest.raises(ValueError, match="candidates"):
        bt.sample_candidates({"maxIter": [5, 10]}, 3)


def test_fit_with_an_empty_feature_and_without_eval_rows(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i), float(i % 5), None, "train" if i < 40 else "test") for i in range(50)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, target double, a double, b double, part string")
    _, pred, used = bt.fit_predict(df.filter("part = 'train'"), df.filter("part = 'test'"), bt.FitSpec("m", "gbt", {"maxIter": 2}), "target", ["a", "b"], [])
    assert pred.count() == 10 and used == ["_n_a_i"]
