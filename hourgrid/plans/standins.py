"""Stand-ins: domain-shaped tables derived by Spark from the driver tables.

The original source data is not available, so each domain table is played by
an aggregate of the generic test tables (``events``, ``lineitem``,
``supplier``, ``orders``, ``customer``, ``nation``). Their size grows with the
inputs; every one is a plain DataFrame derivation.

=============  =====================================================  =========
stand-in       definition                                             plays
=============  =====================================================  =========
hourly         events by (event_type, hour): sum of value       train
daily_dim      events by (event_type, day): distinct users, sum       client
daily_price    events by day: min / max value                         gas
hour_price     events by hour: mean value, origin = hour - 2 days     electricity
flags          (day, event_type, or "none" below a value of 200)      holidays
holes          hourly with target NULL every 17th hour since start    DST gaps
stations       supplier → nation                                      stations
forecast_grid  lineitem rows as point forecasts                       forecast
history_grid   lineitem rows as point readings                        historical
county_fact    lineitem ⋈ supplier by (nation, ship time)             train
orders_fact    orders ⋈ customer                                      merged
=============  =====================================================  =========
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.scalar import shift_time, trunc_ts
from hourgrid.operators.aggregate import rounded, total
from hourgrid.sources.readers import read_table

__all__ = [
    "EVENT_BASE",
    "LINE_BASE",
    "EVENT_TYPES",
    "hourly",
    "daily_dim",
    "daily_price",
    "hour_price",
    "flags",
    "holes",
    "stations",
    "forecast_grid",
    "history_grid",
    "county_fact",
    "orders_fact",
    "STANDIN_KEYS",
]

# Origins of the availability-block numbering and the event
# types that play a flag/holiday type.
EVENT_BASE = "2024-01-01"
LINE_BASE = "1995-01-01"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CONSUMPTION_TYPES = ("click", "view")
FLAG_MIN_VALUE = 200.0
HOLE_EVERY_HOURS = 17


def _block(day_col, base: str, offset: int = 0, per: int = 1):
    days = F.datediff(day_col, F.lit(base).cast("date"))
    if per != 1:
        days = F.floor(days / per)
    return (days + offset).cast("int")


def hourly(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    hour = trunc_ts("hour", "ts")
    out = ev.groupBy("event_type", hour.alias("datetime")).agg(
        rounded(total("value"), 4).alias("target"), F.count(F.lit(1)).cast("long").alias("n")
    )
    return out.withColumns({
        "data_block_id": _block(F.to_date("datetime"), EVENT_BASE),
        "is_consumption": F.col("event_type").isin(*CONSUMPTION_TYPES),
    })


def daily_dim(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    out = ev.groupBy("event_type", F.to_date("ts").alias("date")).agg(
        F.count_distinct("user_id").cast("double").alias("eic_count"), rounded(total("value"), 4).alias("installed_capacity")
    )
    return out.select("event_type", "eic_count", "installed_capacity",
                      _block(F.col("date"), EVENT_BASE, 2).alias("data_block_id"))


def daily_price(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    out = ev.groupBy(F.to_date("ts").alias("date")).agg(
        F.min("value").alias("lowest_price_per_mwh"), F.max("value").alias("highest_price_per_mwh")
    )
    return out.select(_block(F.col("date"), EVENT_BASE, 1).alias("data_block_id"),
                      "lowest_price_per_mwh", "highest_price_per_mwh")


def hour_price(spark: SparkSession, d: str) -> DataFrame:
    """Hourly price with its origin two days earlier (raw electricity shape)."""
    ev = read_table(spark, d, "events")
    out = ev.groupBy(trunc_ts("hour", "ts").alias("hour")).agg(
        (rounded(total("value"), 4) / F.count(F.lit(1))).alias("euros_per_mwh")
    )
    return out.select(shift_time("hour", "-2d").alias("origin_date"), "euros_per_mwh",
                      _block(F.to_date("hour"), EVENT_BASE).alias("data_block_id"))


def flags(spark: SparkSession, d: str) -> DataFrame:
    """Holiday-shaped rows: (date, name, holiday_type); several per date."""
    ev = read_table(spark, d, "events")
    kind = F.when(F.col("value") >= FLAG_MIN_VALUE, F.col("event_type")).otherwise(F.lit("none"))
    return ev.select(F.to_date("ts").alias("date"), F.col("event_id").cast("string").alias("name"), kind.alias("holiday_type"))


def holes(spark: SparkSession, d: str) -> DataFrame:
    """``hourly`` with the target removed every ``HOLE_EVERY_HOURS`` hours."""
    h = hourly(spark, d)
    since = F.timestamp_diff("HOUR", F.lit(EVENT_BASE).cast("timestamp_ntz"), F.col("datetime"))
    return h.withColumn("target", F.when(since % HOLE_EVERY_HOURS != 0, F.col("target")))


def stations(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    n = read_table(spark, d, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("station"), F.lower("n_name").alias("county_name"),
        F.col("s_nationkey").cast("int").alias("county"),
    )


def forecast_grid(spark: SparkSession, d: str) -> DataFrame:
    """Point forecasts: origin = ship day, horizon = 6 h x line number, 2-day blocks."""
    li = read_table(spark, d, "lineitem")
    ha = (F.col("l_linenumber") * 6).cast("int")
    return li.select(
        F.col("l_suppkey").alias("station"),
        F.col("l_shipdate").alias("origin_datetime"),
        ha.alias("hours_ahead"),
        F.timestamp_add("HOUR", ha, F.col("l_shipdate")).alias("forecast_datetime"),
        _block(F.to_date("l_shipdate"), LINE_BASE, per=2).alias("data_block_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def history_grid(spark: SparkSession, d: str) -> DataFrame:
    """Point readings at ship day + 3 h x line number, 2-day blocks."""
    li = read_table(spark, d, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("station"),
        F.timestamp_add("HOUR", (F.col("l_linenumber") * 3).cast("int"), F.col("l_shipdate")).alias("datetime"),
        _block(F.to_date("l_shipdate"), LINE_BASE, per=2).alias("data_block_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def county_fact(spark: SparkSession, d: str) -> DataFrame:
    """Hourly county fact: lineitem ⋈ supplier by (nation, ship day + 6 h x line)."""
    li = read_table(spark, d, "lineitem")
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    t = F.timestamp_add("HOUR", (F.col("l_linenumber") * 6).cast("int"), F.col("l_shipdate"))
    # The block is a function of the time; grouping by it as well leaves the
    # aggregate hash-partitioned on the (county, time, block) join keys of
    # the weather joins, so the fact is not shuffled again for them.
    block = _block(F.to_date(t), LINE_BASE, per=2)
    return li.join(s, li.l_suppkey == s.s_suppkey, "inner").groupBy(
        F.col("s_nationkey").cast("int").alias("county"), t.alias("datetime"), block.alias("data_block_id")
    ).agg(rounded(total("l_extendedprice"), 4).alias("target")).select("county", "datetime", "target", "data_block_id")


def orders_fact(spark: SparkSession, d: str) -> DataFrame:
    """Orders with customer attributes: the table the SQL reports run on."""
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice",
        F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment",
        (F.col("o_orderstatus") == "F").alias("is_final"),
    )


STANDIN_KEYS = {"series": ["event_type"], "time": "datetime", "value": "target"}

