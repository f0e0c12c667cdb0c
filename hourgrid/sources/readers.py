"""Readers (S1-S3, S8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.sources.schemas import SCHEMAS, SOURCE_TABLES

__all__ = ["read_csv_table", "load_csv_tables", "read_id_name_map", "load_parquet_tables", "read_table", "run_sql"]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, read by column name and typed by ``schema`` (S1); no inference pass.

    The header may have the columns in any order and more of them; a declared
    column that it lacks is an error. Flags are 0/1 or true/false. A field that
    does not fit its type raises (ANSI casts), it does not become NULL.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST").csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing}")
    return raw.select(*[_typed(F.col(f"`{f.name}`"), f).alias(f.name) for f in schema.fields])


def _typed(text: Column, field: T.StructField) -> Column:
    plain = F.trim(text)
    plain = F.when(plain != "", plain)
    if isinstance(field.dataType, T.StringType):
        return text
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # "3.0" is how integer columns with gaps are written
        return F.regexp_replace(plain, r"\.0+$", "").cast(field.dataType)
    if isinstance(field.dataType, T.BooleanType):
        low = F.lower(plain)
        flag = F.when(low.isin("1", "1.0", "true", "t"), True).when(low.isin("0", "0.0", "false", "f"), False)
        return F.when(plain.isNull() | flag.isNotNull(), flag).otherwise(
            F.raise_error(F.concat(F.lit(f"{field.name}: not a flag: "), plain)).cast("boolean"))
    return plain.cast(field.dataType)


def load_csv_tables(spark: SparkSession, main_path: str, additional_path: str | None = None,
                    names: Iterable[str] = SOURCE_TABLES, county_map: bool | None = None) -> dict[str, DataFrame]:
    """All source CSVs under ``main_path`` (``{name}.csv``); holidays from ``additional_path``.

    ``county_map`` adds the dimension of the JSON object ``county_id_to_name_map.json``
    beside them (S2); the default is to do so when all tables are loaded.
    """
    names = tuple(names)
    county_map = names == SOURCE_TABLES if county_map is None else county_map
    out = {"county_map": read_id_name_map(spark, f"{main_path.rstrip('/')}/county_id_to_name_map.json")} if county_map else {}
    for name in names:
        base = additional_path if name == "holidays" else main_path
        if base is None:
            continue
        out[name] = read_csv_table(spark, f"{base.rstrip('/')}/{name}.csv", SCHEMAS[name])
    return out


def read_id_name_map(spark: SparkSession, path: str, key_name: str = "county",
                     value_name: str = "county_name") -> DataFrame:
    """A JSON object ``{"0": "name", ...}`` → rows (key INT, value STRING).

    The file is one small object; ``wholetext`` keeps it a single record.
    """
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), T.MapType(T.StringType(), T.StringType()))
    return raw.select(F.explode(m).alias("k", "v")).select(
        F.col("k").cast("int").alias(key_name), F.col("v").alias(value_name)
    )


def load_parquet_tables(spark: SparkSession, path: str, names: Iterable[str] = SOURCE_TABLES) -> dict[str, DataFrame]:
    """Parquet scans of the named tables under ``path`` (S3). Lazy: only the
    columns and row groups a query needs are read."""
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One ``{name}.parquet`` under a directory (driver test tables)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Register ``views`` as temp views and run SQL text (S8); stays lazy."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
