"""Report functions: one-pass grouping sets equal the per-column reports (A6), SQL text equals DataFrame."""

from pyspark.sql import functions as F

from hourgrid.plans import catalog, reports, standins
from tests.conftest import SF_SMALL


def test_category_summaries_equal_individual_reports(spark):
    o = standins.orders_fact(spark, SF_SMALL)
    cats = ["c_mktsegment", "o_orderpriority", "c_nationkey"]
    allc = reports.category_summaries(o, cats, "is_final", "o_totalprice")
    for c in cats:
        one = reports.category_summary(o, c, "is_final", "o_totalprice").select(
            F.lit(c).alias("category"), F.col(c).cast("string").alias("category_value"), "is_final",
            "avg_hourly_target", "total_target")
        part = allc.filter(F.col("category") == c)
        assert part.exceptAll(one).count() == 0 and one.exceptAll(part).count() == 0


def test_sql_text_reports_equal_dataframe_reports(spark):
    for name in ("monthly_change", "top5_month", "daily_moving_avg", "growth_rate", "series_completeness"):
        a = catalog.QUERIES[name](spark, SF_SMALL)
        b = catalog.QUERIES[f"sql_{name}"](spark, SF_SMALL)
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_category_summary_order(spark):
    o = standins.orders_fact(spark, SF_SMALL)
    rows = reports.category_summary(o, "c_mktsegment", "is_final", "o_totalprice").collect()
    flags = [r["is_final"] for r in rows]
    assert flags == sorted(flags)
    for f in set(flags):
        avgs = [r["avg_hourly_target"] for r in rows if r["is_final"] == f]
        assert avgs == sorted(avgs, reverse=True)
