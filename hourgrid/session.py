"""Session settings shared by the library, the tests and the bench; lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Wall-clock timestamps are TIMESTAMP_NTZ and
# the session zone is UTC so that date_trunc/casts never see a DST jump.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Only for local runs (tests, bench): a cluster keeps its own shuffle
# partition count, sized to the data (AQE coalesces small partitions).
LOCAL_CONF = {"spark.sql.shuffle.partitions": "8"}


def get_session(
    master: str | None = None,
    app_name: str = "hourgrid",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(BASE_CONF)
    if master and master.startswith("local"):
        merged.update(LOCAL_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3) folder and is
    used as is; a folder given by ``setCheckpointDir`` comes next. Only a local
    master (tests, local runs) gets a scratch folder under the system temp dir.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return path or given.get()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="hourgrid-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df, name: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None, options: dict | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole plan). Later readers prune by ``partition_by`` directories, or,
    with ``sort_by``, by Parquet row-group statistics (rows are sorted inside
    each task, no shuffle). Never a machine-local folder on a cluster: the
    location comes from ``spark.checkpoint.dir``.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # folder names carry no types: read partition columns back as they were
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)
