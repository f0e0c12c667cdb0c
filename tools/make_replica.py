"""Build a scaled copy of a test-data folder for scale-out measurements.

lineitem and supplier are replicated ``k`` times with disjoint supplier and
order keys (k times the series and rows); the other tables are linked
unchanged. Usage: python tools/make_replica.py <src_sf_dir> <out_dir> <k>
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from hourgrid.session import get_session  # noqa: E402


def main() -> None:
    src, out, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    os.makedirs(out, exist_ok=True)
    spark = get_session("local[8]", "hourgrid-replica")
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    li = spark.read.parquet(f"{src}/lineitem.parquet").select("*", copies)
    off = F.col("_copy").cast("long") * 10_000_000
    li = li.withColumns({"l_suppkey": F.col("l_suppkey") + off, "l_orderkey": F.col("l_orderkey") + off}).drop("_copy")
    li.write.mode("overwrite").parquet(f"{out}/lineitem.parquet")
    su = spark.read.parquet(f"{src}/supplier.parquet").select("*", copies)
    su = su.withColumn("s_suppkey", F.col("s_suppkey") + F.col("_copy").cast("long") * 10_000_000).drop("_copy")
    su.write.mode("overwrite").parquet(f"{out}/supplier.parquet")
    for name in os.listdir(src):
        if name.endswith(".parquet") and name not in ("lineitem.parquet", "supplier.parquet"):
            dst = os.path.join(out, name)
            if not os.path.exists(dst):
                os.symlink(os.path.join(src, name), dst)


if __name__ == "__main__":
    main()
