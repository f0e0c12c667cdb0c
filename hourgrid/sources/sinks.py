"""Sinks (S5-S7)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.scalar import epoch_us
from hourgrid.sources.schemas import SCHEMAS, ddl

__all__ = ["write_overwrite", "replace_table", "load_declared", "write_partitioned_by_day", "read_day_range", "write_clustered", "read_clustered", "publish_version", "read_version", "remove_versions"]


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Idempotent reload: replace the whole output."""
    df.write.mode("overwrite").format(fmt).save(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop-and-recreate a derived table (S6); with ``path`` its files are there and not in the warehouse."""
    w = df.write.mode("overwrite").format("parquet")
    (w.option("path", path) if path else w).saveAsTable(name)


def load_declared(df: DataFrame, name: str, table: str | None = None, path: str | None = None) -> None:
    """Create a declared table unless it exists, then replace its rows by ``df``, matched by name and cast to the declared types."""
    spark, table = df.sparkSession, table or name
    spark.sql(ddl(name, table, path))
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
    rows.write.insertInto(table, overwrite=True)


MANIFEST = "version long, folder string"


def publish_version(df: DataFrame, path: str) -> int:
    """Write ``df`` as a new version of the table at ``path`` and switch readers to it in one step.

    Rows go to a folder of their own; only then one file joins the manifest, by Spark's committer, so readers
    see the old version or the new one and never a part. ``df`` may read the version that it replaces, and a
    write that fails leaves the table as it was. Versions are numbered; of writers at the same time the one
    with the larger folder name counts.
    """
    spark, folder = df.sparkSession, f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    newest = _manifest(spark, path)
    version = (newest[0] if newest else 0) + 1
    spark.createDataFrame([(version, folder)], MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return version


def _manifest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(version, folder) that readers follow."""
    try:
        seen = spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    top = seen.agg(F.max(F.struct("version", "folder")).alias("m")).first()["m"]
    return (top["version"], top["folder"]) if top else None


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of the table at ``path``, or version number ``version`` if it is still there."""
    found = _manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of {path}")
    if version is not None and version != found[0]:
        old = spark.read.schema(MANIFEST).json(f"{path}/manifest").filter(F.col("version") == version).agg(F.max("folder").alias("f")).first()["f"]
        if old is None:
            raise FileNotFoundError(f"no version {version} of {path}")
        found = (version, old)
    return spark.read.parquet(f"{path}/{found[1]}")


def remove_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the rows of all but the newest ``keep`` versions; the manifest keeps its entries. Returns how many folders went."""
    if keep < 1:
        raise ValueError("the newest version can't be removed")
    newest = _manifest(spark, path)
    if newest is None:
        return 0
    old = spark.read.schema(MANIFEST).json(f"{path}/manifest").filter(F.col("version") <= newest[0] - keep).collect()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = 0
    for r in old:
        folder = hadoop.Path(f"{path}/{r['folder']}")
        gone += bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))
    return gone


def write_partitioned_by_day(df: DataFrame, path: str, time_col: str = "datetime",
                             day_col: str = "day", extra_partitions: Sequence[str] = ()) -> None:
    """Fact sink partitioned by calendar day.

    Time filters on ``day`` prune whole directories. Rows are sorted by day
    inside each task (no shuffle by day, so a hot day is still written by many
    tasks) and files are capped by ``maxRecordsPerFile``; the overwrite is
    dynamic, so re-running one day replaces that day only.
    """
    out = df.withColumn(day_col, F.to_date(F.col(time_col)))
    parts = [day_col, *extra_partitions]
    (
        out.sortWithinPartitions(*parts)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 5_000_000)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def read_day_range(spark, path: str, start: str, end: str, day_col: str = "day") -> DataFrame:
    """Read a day-partitioned fact for ``start <= day < end`` (partition pruned)."""
    return spark.read.parquet(path).filter((F.col(day_col) >= F.lit(start).cast("date")) &
                                           (F.col(day_col) < F.lit(end).cast("date")))


#: Bits of each side of a clustered key.
CLUSTER_BITS = 12


def _scaled(x: Column, low: Column, high: Column) -> Column:
    """A number between ``low`` and ``high`` on a scale of 2 ** CLUSTER_BITS steps; NULL comes first."""
    top = (1 << CLUSTER_BITS) - 1
    share = F.when(high > low, (x - low) / (high - low)).otherwise(F.lit(0.0))
    return F.coalesce(F.floor(share * top).cast("int"), F.lit(0))


def interleaved(x: Column, y: Column) -> Column:
    """The bits of two numbers of CLUSTER_BITS bits in turns, those of ``x`` first."""
    out = F.lit(0)
    for i in range(CLUSTER_BITS):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(x, i).bitwiseAND(1), 2 * i + 1)).bitwiseOR(F.shiftleft(F.shiftright(y, i).bitwiseAND(1), 2 * i))
    return out


def write_clustered(df: DataFrame, path: str, series_col: str, time_col: str, files: int = 64) -> None:
    """Fact sink for filters on a numeric series, on time, or on both.

    Rows are range-partitioned on the interleaved bits of series and time, so each file holds a small
    rectangle of both and its Parquet statistics prune either filter; a day folder prunes the day alone.
    The ranges are of equal numbers of rows, so a series or day with many rows is spread over many files.
    """
    t = epoch_us(time_col).cast("double")
    s = F.col(series_col).cast("double")
    b = df.agg(F.min(s).alias("s0"), F.max(s).alias("s1"), F.min(t).alias("t0"), F.max(t).alias("t1"))
    low_high = {c: b.select(c).scalar() for c in b.columns}
    z = interleaved(_scaled(s, low_high["s0"], low_high["s1"]), _scaled(t, low_high["t0"], low_high["t1"]))
    # the last columns part rows of one cell; a hot cell is still one file's range at most of equal keys
    df.withColumn("_z", z).repartitionByRange(files, "_z", series_col, time_col).sortWithinPartitions("_z", series_col, time_col).drop("_z").write.mode("overwrite").parquet(path)


def read_clustered(spark: SparkSession, path: str, series_col: str, series: tuple, time_col: str, start: str, end: str) -> DataFrame:
    """Rows with ``series[0] <= series <= series[1]`` and ``start <= time < end``; both filters reach the file statistics."""
    t = F.col(time_col)
    return spark.read.parquet(path).filter(F.col(series_col).between(*series) & (t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz")))
