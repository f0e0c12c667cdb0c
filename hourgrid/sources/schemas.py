"""Declared schemas of the source tables.

CSV input is never type-inferred: the readers apply these schemas. Timestamps
are wall-clock without zone (TIMESTAMP_NTZ); unsigned/float32 narrowing of the
original is not needed (Parquet encodings take care of size).
"""

from pyspark.sql import types as T

_I, _L, _D, _F, _B = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.BooleanType()
_TS, _DT, _S = T.TimestampNTZType(), T.DateType(), T.StringType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRAIN = _st(
    ("county", _I), ("is_business", _B), ("product_type", _I), ("target", _D), ("is_consumption", _B),
    ("datetime", _TS), ("data_block_id", _I), ("row_id", _L), ("prediction_unit_id", _I),
)
CLIENT = _st(
    ("product_type", _I), ("county", _I), ("eic_count", _I), ("installed_capacity", _D), ("is_business", _B),
    ("date", _DT), ("data_block_id", _I),
)
GAS_PRICES = _st(
    ("forecast_date", _DT), ("lowest_price_per_mwh", _F), ("highest_price_per_mwh", _F), ("origin_date", _DT),
    ("data_block_id", _I),
)
ELECTRICITY_PRICES = _st(
    ("forecast_date", _TS), ("euros_per_mwh", _F), ("origin_date", _TS), ("data_block_id", _I),
)
FORECAST_WEATHER = _st(
    ("latitude", _D), ("longitude", _D), ("origin_datetime", _TS), ("hours_ahead", _I), ("temperature", _D),
    ("dewpoint", _D), ("cloudcover_high", _D), ("cloudcover_low", _D), ("cloudcover_mid", _D),
    ("cloudcover_total", _D), ("10_metre_u_wind_component", _D), ("10_metre_v_wind_component", _D),
    ("data_block_id", _I), ("forecast_datetime", _TS), ("direct_solar_radiation", _D),
    ("surface_solar_radiation_downwards", _D), ("snowfall", _D), ("total_precipitation", _D),
)
HISTORICAL_WEATHER = _st(
    ("datetime", _TS), ("temperature", _D), ("dewpoint", _D), ("rain", _D), ("snowfall", _D),
    ("surface_pressure", _D), ("cloudcover_total", _D), ("cloudcover_low", _D), ("cloudcover_mid", _D),
    ("cloudcover_high", _D), ("windspeed_10m", _D), ("winddirection_10m", _D), ("shortwave_radiation", _D),
    ("direct_solar_radiation", _D), ("diffuse_radiation", _D), ("latitude", _D), ("longitude", _D),
    ("data_block_id", _I),
)
STATIONS = _st(("longitude", _D), ("latitude", _D), ("county_name", _S), ("county", _I))
HOLIDAYS = _st(("date", _DT), ("name", _S), ("holiday_type", _S))

SCHEMAS: dict[str, T.StructType] = {
    "train": TRAIN,
    "client": CLIENT,
    "gas_prices": GAS_PRICES,
    "electricity_prices": ELECTRICITY_PRICES,
    "forecast_weather": FORECAST_WEATHER,
    "historical_weather": HISTORICAL_WEATHER,
    "weather_station_to_county_mapping": STATIONS,
    "holidays": HOLIDAYS,
}

SOURCE_TABLES = tuple(SCHEMAS)


def ddl(name: str, table: str | None = None, path: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` text for a declared table (S4), under its own name or another one, in the warehouse or at ``path``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in SCHEMAS[name].fields)
    return f"CREATE TABLE IF NOT EXISTS {table or name} ({cols}) USING parquet" + (f" LOCATION '{path}'" if path else "")
