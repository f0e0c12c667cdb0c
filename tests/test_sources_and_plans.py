"""Sources/sinks round trips and physical-plan shape checks (S1-S8, J11, plans)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hourgrid.operators.joins import DuplicateKeyError, check_unique, duplicate_keys
from hourgrid.plans import catalog, standins
from hourgrid.sources import readers, schemas, sinks
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scratch():
    return tempfile.mkdtemp(prefix="hourgrid-test-", dir="/tmp")


def test_csv_with_declared_schema(spark):
    d = _scratch()
    path = os.path.join(d, "client.csv")
    with open(path, "w") as f:
        f.write("product_type,county,eic_count,installed_capacity,is_business,date,data_block_id\n")
        f.write("1,0,108,952.89,false,2021-09-01,2\n3,12,,1411.0,true,2021-09-01,2\n")
    df = readers.read_csv_table(spark, path, schemas.CLIENT)
    assert df.schema == schemas.CLIENT
    rows = df.orderBy("product_type").collect()
    assert rows[0]["eic_count"] == 108 and rows[1]["eic_count"] is None
    assert "CREATE TABLE IF NOT EXISTS client" in schemas.ddl("client")


def test_json_id_name_map(spark):
    d = _scratch()
    path = os.path.join(d, "county_id_to_name_map.json")
    with open(path, "w") as f:
        json.dump({"0": "HARJUMAA", "1": "HIIUMAA", "12": "unknown"}, f, indent=2)
    got = {r["county"]: r["county_name"] for r in readers.read_id_name_map(spark, path).collect()}
    assert got == {0: "HARJUMAA", 1: "HIIUMAA", 12: "unknown"}


def test_overwrite_is_idempotent_and_partition_pruned(spark):
    d = _scratch()
    h = standins.hourly(spark, SF_SMALL)
    out = os.path.join(d, "fact")
    sinks.write_partitioned_by_day(h, out)
    sinks.write_partitioned_by_day(h, out)      # re-run replaces, no duplicates
    back = spark.read.parquet(out)
    assert back.count() == h.count()
    sel = sinks.read_day_range(spark, out, "2024-01-03", "2024-01-05")
    assert "PartitionFilters: [isnotnull(day" in sel._jdf.queryExecution().executedPlan().toString() or \
        "day" in str(sel._jdf.queryExecution().executedPlan())
    assert sel.select(F.min("datetime").cast("date").cast("string")).first()[0] == "2024-01-03"
    p2 = os.path.join(d, "plain")
    sinks.write_overwrite(h, p2)
    sinks.write_overwrite(h, p2)
    assert spark.read.parquet(p2).count() == h.count()


def test_replace_table_and_sql(spark):
    spark.sql("DROP TABLE IF EXISTS hourgrid_merged")
    h = standins.hourly(spark, SF_SMALL)
    sinks.replace_table(h, "hourgrid_merged")
    sinks.replace_table(h, "hourgrid_merged")
    n = readers.run_sql(spark, "SELECT count(*) AS n FROM hourgrid_merged").first()["n"]
    assert n == h.count()
    v = readers.run_sql(spark, "SELECT count(*) AS n FROM hv", hv=h).first()["n"]
    assert v == n
    spark.sql("DROP TABLE IF EXISTS hourgrid_merged")


def test_unique_contract(spark):
    li = readers.read_table(spark, SF_SMALL, "lineitem")
    assert duplicate_keys(li, ["l_orderkey", "l_linenumber"]).count() > 0
    with pytest.raises(DuplicateKeyError):
        check_unique(li, ["l_orderkey", "l_linenumber"], "lineitem")
    check_unique(readers.read_table(spark, SF_SMALL, "orders"), ["o_orderkey"])


def test_joins_leave_the_strategy_to_the_planner(spark):
    assert "ResolvedHint" not in catalog.QUERIES["merged_hourly"](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()


def test_csv_by_name_with_flags(spark):
    d = _scratch()
    path = os.path.join(d, "train.csv")
    with open(path, "w") as f:
        f.write("row_id,target,is_business,county,is_consumption,datetime,data_block_id,extra,product_type,prediction_unit_id\n")
        f.write("0,0.713,0,3,1,2021-09-01 00:00:00,0,x,1,7\n1,,1,3,true,2021-09-01 01:00:00,0,x,1,7\n")
    rows = readers.read_csv_table(spark, path, schemas.TRAIN).orderBy("row_id").collect()
    assert [(r.is_business, r.is_consumption, r.target, r.prediction_unit_id) for r in rows] == [(False, True, 0.713, 7), (True, True, None, 7)]


def test_csv_bad_fields_raise(spark):
    d = _scratch()
    for name, line in (("a", "1,maybe"), ("b", "x,1")):
        path = os.path.join(d, f"{name}.csv")
        with open(path, "w") as f:
            f.write(f"n,flag\n{line}\n")
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("flag", T.BooleanType())])
        with pytest.raises(Exception, match="not a flag|CAST_INVALID_INPUT"):
            readers.read_csv_table(spark, path, schema).collect()
    with pytest.raises(ValueError, match="no column"):
        readers.read_csv_table(spark, path, T.StructType([T.StructField("other", T.IntegerType())]))


def test_dimension_joins_broadcast(spark):
    plan = _plan(catalog.QUERIES["merged_hourly"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 4


def test_topk_plans(spark):
    for q in ("first_rows", "top5_month"):
        assert "TakeOrderedAndProject" in _plan(catalog.QUERIES[q](spark, SF_SMALL))


def test_pushdown_and_pruning(spark):
    q = catalog.QUERIES["semi_join_filter"](spark, SF_SMALL)
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_no_python_udfs_in_query_plans(spark):
    for name in ("feature_table", "weather_joined", "interpolate_gaps", "category_all", "naive_scores"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_grouping_sets_single_aggregate(spark):
    plan = _plan(catalog.QUERIES["forecast_county"](spark, SF_SMALL))
    assert plan.count("Expand") == 1


def test_load_table_sets(spark):
    d = _scratch()
    main, extra, pq = os.path.join(d, "main"), os.path.join(d, "extra"), os.path.join(d, "pq")
    os.makedirs(main)
    os.makedirs(extra)
    with open(os.path.join(main, "gas_prices.csv"), "w") as f:
        f.write("forecast_date,lowest_price_per_mwh,highest_price_per_mwh,origin_date,data_block_id\n")
        f.write("2021-09-01,45.23,46.32,2021-08-31,1\n")
    with open(os.path.join(extra, "holidays.csv"), "w") as f:
        f.write("date,name,holiday_type\n2021-12-24,Christmas Eve,public\n")
    got = readers.load_csv_tables(spark, main, extra, names=["gas_prices", "holidays"])
    assert got["gas_prices"].schema == schemas.GAS_PRICES and got["gas_prices"].count() == 1
    assert got["holidays"].first()["holiday_type"] == "public"
    for name, df in got.items():
        df.write.mode("overwrite").parquet(os.path.join(pq, name))
    back = readers.load_parquet_tables(spark, pq + "/", names=["gas_prices", "holidays"])
    assert {n: df.count() for n, df in back.items()} == {"gas_prices": 1, "holidays": 1}


def test_declared_ddl_creates_matching_tables(spark):
    for name, schema in schemas.SCHEMAS.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(schemas.ddl(name))
        spark.sql(schemas.ddl(name))          # IF NOT EXISTS: re-running is a no-op
        got = spark.table(name).schema
        assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in schema.fields], name
        spark.sql(f"DROP TABLE IF EXISTS {name}")
