"""Staged API over the feature plan: load → prepare → merge → calendar → lags → ratios.

Mirrors the step-by-step workflow users of the original run, but every step
only replaces a lazy DataFrame; nothing is computed until the result is
written or collected, so Catalyst still sees one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from hourgrid.operators.timeseries import add_lags_and_rollings
from hourgrid.plans import features as fe
from hourgrid.sources.readers import load_csv_tables, load_parquet_tables

__all__ = ["FeatureWorkflow"]


class FeatureWorkflow:
    """Build the wide hourly feature table step by step."""

    def __init__(self, spark: SparkSession, path: str | None = None, additional_path: str | None = None,
                 fmt: str = "parquet") -> None:
        self.spark = spark
        self.path = path
        self.additional_path = additional_path
        self.fmt = fmt
        self.raw: dict[str, DataFrame] = {}
        self.prepared: dict[str, DataFrame] = {}
        self.df: DataFrame | None = None

    def load(self, tables: Mapping[str, DataFrame] | None = None) -> FeatureWorkflow:
        """Source tables: given DataFrames, or CSV/Parquet files under ``path``."""
        if tables is not None:
            self.raw = dict(tables)
        elif self.fmt == "csv":
            self.raw = load_csv_tables(self.spark, self.path, self.additional_path)
        else:
            self.raw = load_parquet_tables(self.spark, self.path)
        return self

    def prepare(self) -> FeatureWorkflow:
        r = self.raw
        st = fe.prepare_stations(r["weather_station_to_county_mapping"])
        self.prepared = {
            "train": fe.prepare_train(r["train"]),
            "client": fe.prepare_client(r["client"]),
            "gas_prices": fe.prepare_gas_prices(r["gas_prices"]),
            "electricity_prices": fe.prepare_electricity_prices(r["electricity_prices"]),
            "forecast_weather": fe.prepare_forecast_weather(r["forecast_weather"]),
            "historical_weather": fe.prepare_historical_weather(r["historical_weather"]),
            "weather_station_to_county_mapping": st,
        }
        if "holidays" in r:
            self.prepared["holidays"] = fe.prepare_holidays(r["holidays"])
        return self

    def merge(self, validate: bool = False) -> FeatureWorkflow:
        """Join everything to the hourly fact; dimension keys must be unique. ``validate`` also checks the stations."""
        p = self.prepared
        st = p["weather_station_to_county_mapping"]
        self.df = fe.merge_fact(
            p["train"], p["client"], p["gas_prices"], p["electricity_prices"],
            fe.aggregate_forecast(p["forecast_weather"], st, validate=validate),
            fe.aggregate_historical(p["historical_weather"], st, validate=validate),
            p.get("holidays"),
        )
        return self

    def transform_datetime(self, time_col: str = "datetime") -> FeatureWorkflow:
        self.df = fe.add_time_features(self._need(), time_col)
        return self

    def add_lags_and_rollings(self, value_col: str, lag_specs: Mapping[str, Mapping[str, Sequence[str]] | None],
                              datetime_col: str = "datetime",
                              group_cols: Sequence[str] = ("county", "product_type", "is_business", "is_consumption"),
                              validate: bool = False, bucket: str | int | None = "auto") -> FeatureWorkflow:
        self.df = add_lags_and_rollings(self._need(), value_col, lag_specs, datetime_col, list(group_cols), bucket=bucket,
                                        validate=validate)
        return self

    def add_ratio_features(self) -> FeatureWorkflow:
        self.df = fe.add_ratio_features(self._need())
        return self

    def _need(self) -> DataFrame:
        if self.df is None:
            raise RuntimeError("call merge() first")
        return self.df
