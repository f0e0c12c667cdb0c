"""County weather means, unit conversions, calendar and DST."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import calendar as cal
from hourgrid.functions import scalar as fx
from hourgrid.operators.aggregate import county_mean, pivot_any
from hourgrid.plans.features import (
    merge_fact,
    prepare_forecast_weather,
    prepare_historical_weather,
    prepare_stations,
)

T = dt.datetime(2022, 1, 1, 10)


def test_county_mean_levels_and_mapping(spark):
    stations = spark.createDataFrame(
        [(1, 1, 0), (1, 2, 0), (2, 1, 5), (3, 3, 12), (9, 9, 7)],  # (9,9) has no readings
        "latitude int, longitude int, county int")
    weather = spark.createDataFrame(
        [(1, 1, T, 1, 1.0, 2), (1, 2, T, 1, 3.0, 3), (2, 1, T, 1, 11.0, 4), (3, 3, T, 1, 100.0, 9),
         (4, 4, T, 1, 1000.0, 9)],  # (3,3) county 12 excluded, (4,4) unmapped
        "latitude int, longitude int, datetime timestamp_ntz, data_block_id int, temperature double, cloud int")
    out = {r["county"]: r for r in county_mean(weather, stations).collect()}
    assert set(out) == {0, 5, 12}
    assert out[0]["temperature"] == 2.0
    assert out[5]["temperature"] == 11.0
    # overall mean is over stations (1, 3, 11), not over county means (2, 11)
    assert out[12]["temperature"] == 5.0
    # integer measures are rounded half-even and keep their type: mean(2, 3) = 2.5 -> 2
    assert out[0]["cloud"] == 2 and isinstance(out[0]["cloud"], int)
    assert out[12]["cloud"] == 3


def test_forecast_weather_conversions(spark):
    row = (57.65, 21.7, T, 1, 0.5, 0.2, 0.1, 0.2, 0.3, 0.4, 3.0, 4.0, 1, T + dt.timedelta(hours=1),
           -5.0, 10.0, 0.00005, -0.00005)
    cols = ("latitude double, longitude double, origin_datetime timestamp_ntz, hours_ahead int, temperature double, "
            "dewpoint double, cloudcover_high double, cloudcover_low double, cloudcover_mid double, "
            "cloudcover_total double, `10_metre_u_wind_component` double, `10_metre_v_wind_component` double, "
            "data_block_id int, forecast_datetime timestamp_ntz, direct_solar_radiation double, "
            "surface_solar_radiation_downwards double, snowfall double, total_precipitation double")
    r = prepare_forecast_weather(spark.createDataFrame([row], cols)).collect()[0]
    assert (r["latitude"], r["longitude"]) == (577, 217)
    assert r["windspeed"] == 5.0
    assert r["direct_solar_radiation"] == 0.0          # clipped at 0
    assert r["surface_solar_radiation_downwards"] == 10.0
    assert r["snowfall_mm"] == 0.0 and r["total_precipitation_mm"] == 0.0   # |0.05 mm| < 0.1 mm


def test_historical_weather_wind_and_dedupe(spark):
    cols = ("datetime timestamp_ntz, temperature double, dewpoint double, rain double, snowfall double, "
            "surface_pressure double, cloudcover_total double, cloudcover_low double, cloudcover_mid double, "
            "cloudcover_high double, windspeed_10m double, winddirection_10m double, shortwave_radiation double, "
            "direct_solar_radiation double, diffuse_radiation double, latitude double, longitude double, "
            "data_block_id int")
    base = [T, 1.0, 0.0, 0.0, 2.0, 1000.0, 1.0, 1.0, 1.0, 1.0, 2.0, 90.0, 0.0, 0.0, 0.0, 57.6, 21.7, 1]
    dup = list(base)
    dup[1] = 0.5
    out = prepare_historical_weather(spark.createDataFrame([tuple(base), tuple(dup)], cols)).collect()
    assert len(out) == 1 and out[0]["temperature"] == 0.5
    assert math.isclose(out[0]["u_component"], -2.0)
    assert abs(out[0]["v_component"]) < 1e-12
    assert out[0]["snowfall_mm"] == 2.0


def test_stations_fill_unknown(spark):
    df = spark.createDataFrame([(21.7, 57.6, None, None), (22.2, 58.3, "Tartumaa", 10)],
                               "longitude double, latitude double, county_name string, county int")
    got = {r["latitude"]: (r["county_name"], r["county"]) for r in prepare_stations(df).collect()}
    assert got[576] == ("unknown", 12) and got[583] == ("tartumaa", 10)


def test_h2d_block_shift_at_hours_10_and_11(spark):
    fact = spark.createDataFrame(
        [(0, dt.datetime(2022, 1, 3, 10), 6, 1.0), (0, dt.datetime(2022, 1, 3, 11), 5, 1.0)],
        "county int, datetime timestamp_ntz, data_block_id int, target double")
    hist = spark.createDataFrame(
        [(0, dt.datetime(2022, 1, 1, 10), 5, 10.0), (0, dt.datetime(2022, 1, 1, 11), 5, 11.0)],
        "county int, datetime timestamp_ntz, data_block_id int, temperature double")
    out = merge_fact(fact, historical=hist, keys=__import__("hourgrid.plans.features", fromlist=["MergeKeys"])
                     .MergeKeys(unit=("county",))).orderBy("datetime").collect()
    assert out[0]["h2d_temperature"] == 10.0   # 10:00 -> block + 1 = 6 matches
    assert out[1]["h2d_temperature"] == 11.0   # 11:00 -> block unchanged = 5 matches
    assert out[0]["h1d_temperature"] is None


def test_dst_flag_switch_instants(spark):
    ts = ["2021-10-31 02:00:00", "2021-10-31 03:00:00", "2022-03-27 02:00:00", "2022-03-27 03:00:00",
          "2022-10-30 02:59:59", "2022-10-30 03:00:00", "2023-03-26 03:00:00"]
    df = spark.createDataFrame([(t,) for t in ts], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(cal.dst_flag("t")).collect()]
    assert got == [True, False, False, True, True, False, True]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 23),), (dt.datetime(2023, 1, 2, 0),)], "datetime timestamp_ntz")
    r = cal.add_calendar_features(df).orderBy("datetime").collect()
    assert r[0]["day_of_week"] == 6 and r[1]["day_of_week"] == 0    # Sunday, Monday (Monday = 0)
    assert r[0]["week_of_year"] == 52 and r[1]["week_of_year"] == 1  # ISO week
    assert r[0]["hour"] == 23 and r[0]["quarter"] == 1
    with pytest.raises(KeyError):
        cal.add_calendar_features(df, "missing")


def test_cyclic_features(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 6),)], "datetime timestamp_ntz")
    r = cal.add_cyclic_features(df).collect()[0]
    assert abs(r["hour_sin"] - 1.0) < 1e-6 and abs(r["hour_cos"]) < 1e-6
    assert "hour" not in r.asDict()


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(0.0, 5.0, 2.5, -1.0, 0.05)], "zero double, five double, half double, neg double, p double")
    r = df.select(
        fx.safe_ratio("five", "zero").alias("ratio"), fx.round_half_even("half").alias("even"),
        fx.round_half_up("half").alias("up"), fx.clip_lower("neg", 0.0).alias("clip"),
        fx.zero_below("p", 0.1).alias("zb"), fx.shift_time(F.lit(T), "-2d").alias("shift"),
        fx.shift_months(F.lit(dt.datetime(2023, 1, 31, 5)), 1).alias("m"),
    ).collect()[0]
    assert r["ratio"] is None and r["even"] == 2.0 and r["up"] == 3.0 and r["clip"] == 0.0 and r["zb"] == 0.0
    assert r["shift"] == T - dt.timedelta(days=2)
    assert r["m"] == dt.datetime(2023, 2, 28, 5)
    assert fx.parse_duration_us("49h") == 49 * 3_600_000_000
    with pytest.raises(ValueError):
        fx.parse_duration_us("1M")


def test_pivot_any_two_types_one_date(spark):
    hol = spark.createDataFrame(
        [(dt.date(2022, 1, 1), "a"), (dt.date(2022, 1, 1), "b"), (dt.date(2022, 1, 1), "a"), (dt.date(2022, 1, 2), "b")],
        "date date, holiday_type string")
    got = {r["date"]: (r["a"], r["b"]) for r in pivot_any(hol, "date", "holiday_type", ["a", "b"]).collect()}
    assert got == {dt.date(2022, 1, 1): (True, True), dt.date(2022, 1, 2): (False, True)}


def test_trunc_is_time_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Tallinn")
    try:
        df = spark.createDataFrame([("2022-03-27 03:30:00",)], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("t"))
        r = df.select(fx.trunc_ts("hour", "t").alias("h"), fx.trunc_ts("month", "t").alias("m")).collect()[0]
        assert r["h"] == dt.datetime(2022, 3, 27, 3) and r["m"] == dt.datetime(2022, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
