"""The wide hourly feature table: prepare → merge → calendar → lags → ratios.

Everything is one lazy plan. The merge is parametric in column names
(:class:`MergeKeys`) so the same chain runs on the domain tables and on any
table of that shape.

Physical shape of :func:`merge_fact` (see ``explain``): the fact is scanned
once; client, gas, electricity and holiday dimensions are broadcast only when
their row count is proven small, otherwise AQE decides; the two weather
aggregates are each computed once and joined twice (f0d/f1d, h2d/h1d).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.calendar import add_calendar_features, dst_flag
from hourgrid.functions.scalar import (
    clip_lower,
    grid_key,
    m_to_mm,
    safe_ratio,
    shift_time,
    snow_cm_to_mm,
    to_day,
    wind_speed,
    wind_u,
    wind_v,
    zero_below,
)
from hourgrid.operators.aggregate import county_mean, pivot_any
from hourgrid.operators.clean import drop_null_rows, fill_constants
from hourgrid.operators.joins import (
    lookup_join,
    multi_shift_lookup,
    shifted_lookup,
)
from hourgrid.operators.timeseries import keep_first, keep_last

__all__ = [
    "MergeKeys",
    "FORECAST_MEASURES",
    "HISTORICAL_MEASURES",
    "prepare_train",
    "prepare_client",
    "prepare_gas_prices",
    "prepare_electricity_prices",
    "prepare_forecast_weather",
    "prepare_historical_weather",
    "prepare_stations",
    "prepare_holidays",
    "aggregate_forecast",
    "aggregate_historical",
    "merge_fact",
    "merge_alternate",
    "add_time_features",
    "add_ratio_features",
    "build_feature_table",
    "LAG_SPECS_BASELINE",
    "LAG_SPECS_FEATURES",
]

# The measure lists kept from each weather source.
FORECAST_MEASURES = (
    "temperature", "dewpoint", "snowfall_mm", "total_precipitation_mm", "cloudcover_low", "cloudcover_mid",
    "cloudcover_high", "cloudcover_total", "u_component", "v_component", "windspeed", "direct_solar_radiation",
    "surface_solar_radiation_downwards",
)
HISTORICAL_MEASURES = (
    "temperature", "dewpoint", "snowfall_mm", "rain_mm", "surface_pressure", "cloudcover_low", "cloudcover_mid",
    "cloudcover_high", "cloudcover_total", "windspeed", "u_component", "v_component", "shortwave_radiation",
    "direct_solar_radiation", "diffuse_radiation",
)

# lag/rolling specifications used by the two experiment stages.
LAG_SPECS_BASELINE = {"2d": {"6h": ["mean"], "12h": ["mean"], "24h": ["mean"]}, "3d": None,
                      "7d": {"12h": ["mean"], "24h": ["mean"]}}
LAG_SPECS_FEATURES = {"2d": {"6h": ["mean"], "12h": ["mean"], "24h": ["mean"], "168h": ["mean"]},
                      "3d": {"6h": ["mean"], "12h": ["mean"]}, "7d": {"12h": ["mean"], "24h": ["mean"]}}


@dataclass(frozen=True)
class MergeKeys:
    """Column names used by the merge chain."""

    unit: Sequence[str] = ("county", "product_type", "is_business")
    block: str = "data_block_id"
    time: str = "datetime"
    county: str = "county"
    date: str = "date"
    forecast_time: str = "forecast_datetime"
    forecast_drop: Sequence[str] = ("origin_datetime", "hours_ahead")
    prefixes: Mapping[str, str] = field(default_factory=lambda: {"f0d": "f0d_", "f1d": "f1d_", "h2d": "h2d_",
                                                                 "h1d": "h1d_"})


# ------------------------------------------------------------------ prepare


def prepare_train(train: DataFrame) -> DataFrame:
    cols = ["county", "product_type", "is_business", "is_consumption", "datetime", "target", "data_block_id"]
    out = drop_null_rows(train.select(*cols))
    return out.withColumn("date", to_day("datetime"))


def prepare_client(client: DataFrame) -> DataFrame:
    return client.select(
        "county", "product_type", "is_business", F.col("eic_count").cast("double").alias("eic_count"),
        F.col("installed_capacity").cast("double").alias("installed_capacity"), "data_block_id",
    )


def prepare_gas_prices(gas: DataFrame) -> DataFrame:
    return gas.select(
        "data_block_id", F.col("lowest_price_per_mwh").cast("double").alias("lowest_price_per_mwh"),
        F.col("highest_price_per_mwh").cast("double").alias("highest_price_per_mwh"),
    )


def prepare_electricity_prices(elec: DataFrame, shift: str = "2d") -> DataFrame:
    """Prices become known ``shift`` after their origin: key them by origin + shift."""
    return elec.select(
        shift_time(F.col("origin_date").cast("timestamp_ntz"), shift).alias("datetime"),
        F.col("euros_per_mwh").cast("double").alias("euros_per_mwh"), "data_block_id",
    )


def prepare_forecast_weather(fw: DataFrame, threshold_mm: float = 0.1) -> DataFrame:
    u, v = F.col("10_metre_u_wind_component"), F.col("10_metre_v_wind_component")
    return fw.select(
        grid_key("latitude").alias("latitude"), grid_key("longitude").alias("longitude"),
        "origin_datetime", "hours_ahead", "forecast_datetime", "data_block_id", "temperature", "dewpoint",
        zero_below(m_to_mm("snowfall"), threshold_mm).alias("snowfall_mm"),
        zero_below(m_to_mm("total_precipitation"), threshold_mm).alias("total_precipitation_mm"),
        "cloudcover_low", "cloudcover_mid", "cloudcover_high", "cloudcover_total",
        u.alias("u_component"), v.alias("v_component"), wind_speed(u, v).alias("windspeed"),
        clip_lower("direct_solar_radiation", 0.0).alias("direct_solar_radiation"),
        clip_lower("surface_solar_radiation_downwards", 0.0).alias("surface_solar_radiation_downwards"),
    )


def prepare_historical_weather(hw: DataFrame) -> DataFrame:
    """Unit fixes and wind components; duplicate readings keep one copy.

    The source drops two fixed row positions; positions do not exist here,
    so duplicates of (point, datetime, block) are reduced to the copy that is
    smallest by its measures. Points are told apart by their coordinates as
    read: two points of one grid cell both stay for the county mean.
    """
    hw = keep_first(hw, ["latitude", "longitude", "datetime", "data_block_id"])
    return hw.select(
        grid_key("latitude").alias("latitude"), grid_key("longitude").alias("longitude"), "datetime",
        "data_block_id", "temperature", "dewpoint", snow_cm_to_mm("snowfall").alias("snowfall_mm"),
        F.col("rain").alias("rain_mm"), "surface_pressure", "cloudcover_low", "cloudcover_mid", "cloudcover_high",
        "cloudcover_total", F.col("windspeed_10m").alias("windspeed"),
        wind_u("windspeed_10m", "winddirection_10m").alias("u_component"),
        wind_v("windspeed_10m", "winddirection_10m").alias("v_component"),
        "shortwave_radiation", "direct_solar_radiation", "diffuse_radiation",
    )


def prepare_stations(st: DataFrame, unknown_county: int = 12) -> DataFrame:
    out = st.select(grid_key("latitude").alias("latitude"), grid_key("longitude").alias("longitude"),
                    "county_name", F.col("county").cast("int").alias("county"))
    out = fill_constants(out, {"county_name": "unknown", "county": unknown_county})
    return out.withColumn("county_name", F.lower("county_name"))


def prepare_holidays(hol: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """One row per date, one boolean column per holiday type."""
    return pivot_any(hol.select(F.to_date("date").alias("date"), "holiday_type"), "date", "holiday_type", types)


def aggregate_forecast(fw: DataFrame, stations: DataFrame, point_cols=("latitude", "longitude"),
                       county_col: str = "county", keys: MergeKeys = MergeKeys(), validate: bool = False) -> DataFrame:
    """County means of the forecast, then one row per (county, forecast time, block).

    Two origins can forecast the same hour inside one block (DST); the latest
    origin, then the longest horizon, wins.
    """
    agg = county_mean(fw, stations, point_cols, county_col, validate=validate)
    return keep_last(agg, [county_col, keys.forecast_time, keys.block], ["origin_datetime", "hours_ahead"])


def aggregate_historical(hw: DataFrame, stations: DataFrame, point_cols=("latitude", "longitude"),
                         county_col: str = "county", validate: bool = False) -> DataFrame:
    """County means of the historical weather (A1)."""
    return county_mean(hw, stations, point_cols, county_col, validate=validate)


# ------------------------------------------------------------------ merge


def merge_fact(
    train: DataFrame,
    client: DataFrame | None = None,
    gas: DataFrame | None = None,
    electricity: DataFrame | None = None,
    forecast: DataFrame | None = None,
    historical: DataFrame | None = None,
    holidays: DataFrame | None = None,
    keys: MergeKeys = MergeKeys(),
    validate: bool = True,
    how: str = "left",
    h2d_block_shift: bool = True,
    drop_helpers: bool = True,
) -> DataFrame:
    """Left-join chain from the hourly fact to its dimensions.

    * client on (unit keys, block) — J1
    * gas prices on block — J2
    * electricity prices on (time, block) — J3 (already keyed by origin + 2 days)
    * forecast: today's forecast as tomorrow's feature (forecast time + 1 day,
      prefix f0d_) and the 1-day-ahead forecast (f1d_) — J4, J5
    * historical weather 2 days ago (time + 2 days; block + 1 for hours <= 10
      when ``h2d_block_shift``; prefix h2d_) and 1 day ago (h1d_) — J6, J7
    * holiday flags by date, absent → False — J8

    ``validate`` (on by default) is the m:1 contract: a dimension key that
    occurs twice raises when the merge runs (J11).
    ``how`` is passed to every join (J12). Each weather aggregate is computed
    once and joined once: its two shifted copies are folded into one wide
    row per (county, time, block) before the join (:func:`multi_shift_lookup`).
    """
    p = keys.prefixes
    df = train
    if client is not None:
        df = lookup_join(df, client, [*keys.unit, keys.block], how, validate, "client")
    if gas is not None:
        df = lookup_join(df, gas, [keys.block], how, validate, "gas_prices")
    if electricity is not None:
        df = lookup_join(df, electricity, [keys.time, keys.block], how, validate, "electricity_prices")
    fkeys = [keys.county, keys.time, keys.block]
    if forecast is not None:
        dk = [keys.county, keys.forecast_time, keys.block]
        df = multi_shift_lookup(df, forecast, fkeys, dk,
                                [(p["f0d"], {keys.forecast_time: "1d"}), (p["f1d"], None)],
                                drop=keys.forecast_drop, how=how)
    if historical is not None:
        dk = [keys.county, keys.time, keys.block]
        shift2: dict = {keys.time: "2d"}
        if h2d_block_shift:
            blk = F.col(keys.block)
            shift2[keys.block] = F.when(F.hour(keys.time) <= 10, blk + 1).otherwise(blk).cast(
                historical.schema[keys.block].dataType)
            df = multi_shift_lookup(df, historical, fkeys, dk,
                                    [(p["h2d"], shift2), (p["h1d"], {keys.time: "1d"})], how=how)
        else:
            df = shifted_lookup(df, historical, fkeys[:2], dk[:2], p["h2d"], shift2, drop=[keys.block], how=how,
                                validate=validate)
            df = shifted_lookup(df, historical, fkeys, dk, p["h1d"], {keys.time: "1d"}, how=how,
                                validate=validate)
    if holidays is not None:
        flags = [c for c in holidays.columns if c != keys.date]
        df = lookup_join(df, holidays, [keys.date], how, validate, "holidays")
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
    if drop_helpers:
        df = df.drop(keys.block, keys.date)
    return df


# ------------------------------------------------------------------ features


def add_time_features(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """DST flag and calendar parts."""
    return add_calendar_features(df.withColumn("dst", dst_flag(time_col)), time_col)


def add_ratio_features(df: DataFrame, lag_col: str = "target_lag_2d", capacity: str = "installed_capacity",
                       count: str = "eic_count") -> DataFrame:
    """target lag / capacity and capacity / count, NULL on a zero denominator."""
    return df.withColumns({"target_to_capacity": safe_ratio(lag_col, capacity),
                           "capacity_to_eic": safe_ratio(capacity, count)})


def build_feature_table(
    tables: Mapping[str, DataFrame],
    lag_specs: Mapping[str, Mapping[str, Sequence[str]] | None] = LAG_SPECS_BASELINE,
    group_cols: Sequence[str] = ("county", "product_type", "is_business", "is_consumption"),
    validate: bool = False,
    bucket: str | int | None = "auto",
) -> DataFrame:
    """All steps of the staged workflow in one call: raw source tables to the wide feature table."""
    from hourgrid.plans.workflow import FeatureWorkflow

    return (FeatureWorkflow(tables["train"].sparkSession).load(tables).prepare().merge(validate).transform_datetime()
            .add_lags_and_rollings("target", lag_specs, "datetime", group_cols, validate, bucket).add_ratio_features().df)


def merge_alternate(
    train: DataFrame,
    client: DataFrame | None = None,
    gas: DataFrame | None = None,
    electricity: DataFrame | None = None,
    forecast: DataFrame | None = None,
    historical: DataFrame | None = None,
    holidays: DataFrame | None = None,
    how: str = "left",
    keys: MergeKeys = MergeKeys(),
    f_prefix: str = "f1_",
    h_prefix: str = "h2_",
    drop_helpers: bool = True,
) -> DataFrame:
    """The second merge variant (J12): join type as a parameter.

    The forecast aggregate is joined unshifted on (county, forecast time,
    block) with prefix ``f1_`` (no keep-last step); the historical aggregate
    is joined on (county, time + 2 days) *without* the block key, prefix
    ``h2_``. Holidays as in :func:`merge_fact`. The block and the date are
    dropped at the end.
    """
    df = train
    if client is not None:
        df = lookup_join(df, client, [*keys.unit, keys.block], how, False, "client")
    if gas is not None:
        df = lookup_join(df, gas, [keys.block], how, False, "gas_prices")
    if electricity is not None:
        df = lookup_join(df, electricity, [keys.time, keys.block], how, False, "electricity")
    if forecast is not None:
        df = shifted_lookup(df, forecast, [keys.county, keys.time, keys.block],
                            [keys.county, keys.forecast_time, keys.block], f_prefix, None,
                            drop=keys.forecast_drop, how=how)
    if historical is not None:
        df = shifted_lookup(df, historical, [keys.county, keys.time], [keys.county, keys.time], h_prefix,
                            {keys.time: "2d"}, drop=[keys.block], how=how)
    if holidays is not None:
        flags = [c for c in holidays.columns if c != keys.date]
        df = lookup_join(df, holidays, [keys.date], how, False, "holidays")
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
    if drop_helpers:
        df = df.drop(keys.block, keys.date)
    return df
