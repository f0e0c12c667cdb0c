"""Edge rules of SURVEY 1.3 and the remaining property checks of 5.3."""

import datetime as dt
import math

from pyspark.sql import functions as F

from hourgrid.operators.aggregate import county_mean
from hourgrid.operators.clean import drop_null_rows
from hourgrid.operators.joins import duplicate_keys, lookup_join
from hourgrid.plans import backtest as bt
from hourgrid.plans import catalog
from hourgrid.plans.reports import first_rows
from tests.conftest import SF_SMALL


def test_nan_is_dropped_like_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, target double")
    assert [r["k"] for r in drop_null_rows(df).collect()] == [3]


def test_null_join_keys_do_not_match(spark):
    fact = spark.createDataFrame([(None, 1.0), (1, 2.0)], "county int, target double")
    dim = spark.createDataFrame([(None, 10.0), (1, 20.0)], "county int, eic double")
    got = {r["target"]: r["eic"] for r in lookup_join(fact, dim, ["county"]).collect()}
    assert got == {1.0: None, 2.0: 20.0}


def test_first_rows_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "v int")
    assert [r["v"] for r in first_rows(df, ["v"], 3).collect()] == [1, 2, None]


def test_division_by_zero_is_null_not_error(spark):
    from hourgrid.plans.features import add_ratio_features

    df = spark.createDataFrame([(5.0, 0.0, 0.0)], "target_lag_2d double, installed_capacity double, eic_count double")
    r = add_ratio_features(df).collect()[0]
    assert r["target_to_capacity"] is None and r["capacity_to_eic"] is None


def test_share_folds_are_disjoint_and_ordered(spark):
    df = spark.range(24 * 90).select(F.timestamp_add("HOUR", F.col("id").cast("int"),
                                                     F.lit(dt.datetime(2023, 1, 1))).alias("datetime"))
    for f in bt.share_folds(df, "datetime", n_val_splits=3, n_test_splits=3, fh=7).collect():
        assert f["train_start"] <= f["train_end"] < f["test_start"] <= f["test_end"]
        assert f["test_start"] - f["train_end"] == dt.timedelta(hours=1)
    mf = bt.month_folds(df, "datetime", 1, 1, 1, 2).orderBy("fold").collect()
    assert mf[0]["test_start"] == mf[1]["test_start"] - dt.timedelta(days=28)   # Feb has 28 days


def test_weather_levels_have_unique_keys(spark):
    agg = catalog.QUERIES["forecast_county"](spark, SF_SMALL)
    keys = ["county", "origin_datetime", "hours_ahead", "forecast_datetime", "data_block_id"]
    assert duplicate_keys(agg, keys).count() == 0
    assert agg.filter("county = 12").count() > 0


def test_county_mean_over_stations_not_counties(spark):
    st = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "station long, county int")
    w = spark.createDataFrame([(1, 1, 0.0), (2, 1, 0.0), (3, 1, 9.0)], "station long, data_block_id int, t double")
    out = {r["county"]: r["t"] for r in county_mean(w, st, ["station"], "county").collect()}
    assert math.isclose(out[12], 3.0) and out[0] == 0.0 and out[1] == 9.0


def test_join_contracts(spark):
    import pytest

    from hourgrid.operators.joins import DuplicateKeyError

    fact = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    dim = spark.createDataFrame([(1, "a")], "k int, name string")
    assert lookup_join(fact, dim, ["k"], validate="m:1").count() == 2
    with pytest.raises(DuplicateKeyError):
        lookup_join(fact, dim, ["k"], validate="1:1")
    with pytest.raises(Exception, match="not unique"):  # checked inside the plan
        lookup_join(dim, fact, ["k"], validate="m:1").collect()
    assert lookup_join(dim, fact, ["k"], validate="1:m").count() == 2
    with pytest.raises(ValueError):
        lookup_join(fact, dim, ["k"], validate="many")
    st = spark.createDataFrame([(1, 0), (1, 5)], "station long, county int")
    w = spark.createDataFrame([(1, 1, 0.0)], "station long, data_block_id int, t double")
    with pytest.raises(DuplicateKeyError):
        county_mean(w, st, ["station"], "county", validate=True)


def test_lookup_join_with_key_mapping(spark):
    fact = spark.createDataFrame([(1, 10.0), (2, 20.0)], "unit int, v double")
    dim = spark.createDataFrame([(1, "a")], "unit_id int, name string")
    out = lookup_join(fact, dim, {"unit": "unit_id"})
    assert out.columns == ["unit", "v", "name"]
    assert {r["unit"]: r["name"] for r in out.collect()} == {1: "a", 2: None}


def test_top_k_per_group(spark):
    from hourgrid.operators.aggregate import top_k_per_group

    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "g string, v int")
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], 2)
    assert sorted((r["g"], r["v"], r["rank"]) for r in out.collect()) == [("a", 2, 2), ("a", 3, 1), ("b", 5, 1)]


def test_merge_alternate_join_type_and_holidays(spark):
    from hourgrid.plans.features import MergeKeys, merge_alternate

    fact = spark.createDataFrame(
        [(0, dt.datetime(2022, 1, 3, 10), 1, dt.date(2022, 1, 3)), (0, dt.datetime(2022, 1, 4, 10), 2, dt.date(2022, 1, 4))],
        "county int, datetime timestamp_ntz, data_block_id int, date date")
    gas = spark.createDataFrame([(1, 40.0, 50.0)], "data_block_id int, lowest_price_per_mwh double, highest_price_per_mwh double")
    hol = spark.createDataFrame([(dt.date(2022, 1, 3), True)], "date date, public boolean")
    keys = MergeKeys(unit=("county",))
    left = merge_alternate(fact, gas=gas, holidays=hol, how="left", keys=keys, drop_helpers=False)
    inner = merge_alternate(fact, gas=gas, holidays=hol, how="inner", keys=keys)
    assert left.count() == 2 and inner.count() == 1
    flags = {r["data_block_id"]: r["public"] for r in left.collect()}
    assert flags == {1: True, 2: False}


def test_with_scalars_attaches_one_row_without_join(spark):
    from hourgrid.operators.joins import with_scalars

    df = spark.range(5).withColumnRenamed("id", "x")
    bounds = df.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    out = with_scalars(df, bounds)
    assert {(r["lo"], r["hi"]) for r in out.collect()} == {(0, 4)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
