"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would also change other alphabets."""
    return F.translate(col, _UPPER, _LOWER)


def md5_int(key: Column, digits: int = 13) -> Column:
    """The first ``digits`` hex digits of md5(key) as a non-negative long."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, digits), 16, 10).cast("long")


def key_text(col: Column) -> Column:
    """A key as text; null has a text of its own."""
    return F.coalesce(col.cast("string"), F.lit("null"))


#: Keys whose rows are joined by broadcast; every other key holds less than a thousandth of the rows.
HOT_KEYS = 1_000
#: Bits of a set of hashes that is broadcast: 2,048 bitmaps of 4 KB.
SET_BITS = 1 << 26


def quoted(name: str) -> str:
    """A column name as text that ``F.col`` takes as one name, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Hot:
    """The most frequent keys of a table, and whether they are all of its keys."""

    keys: DataFrame
    complete: bool


def hot_keys(counted: DataFrame, on: list[str], n: str, most: int | None = None) -> Hot:
    """The ``most`` keys with the largest ``n``; ``counted`` has one row per key, keys are not null."""
    most = HOT_KEYS if most is None else most
    schema = StructType([counted.schema[c] for c in on])
    top = counted.orderBy(F.desc(n), *on).limit(most + 1).select(*on).collect()
    return Hot(counted.sparkSession.createDataFrame([tuple(r) for r in top[:most]], schema), len(top) <= most)


def attach(big: DataFrame, small: DataFrame, on: list[str], hot: Hot) -> DataFrame:
    """Left join a table with one row per key whose keys may be hot in ``big``.

    Rows of the ``hot`` keys meet their rows of ``small``, as few as there are hot keys, by broadcast; rows
    of other keys are exchanged by key, and no such key has many. Where all keys are hot, none are exchanged.
    """
    names = [*big.columns, *(c for c in small.columns if c not in on)]
    few = F.broadcast(small.join(F.broadcast(hot.keys), on, "left_semi"))
    if hot.complete:
        return big.join(few, on, "left").select(*map(quoted, names))
    marked = big.join(F.broadcast(hot.keys.withColumn("_hot", F.lit(True))), on, "left")
    near = marked.where("_hot").join(few, on, "left").select(*map(quoted, names))
    far = marked.where("_hot IS NULL").join(small, on, "left").select(*map(quoted, names))
    return near.union(far)


def mark_possible(rows: DataFrame, hashed: Column, keys: DataFrame, key_hash: Column, out: str) -> DataFrame:
    """``rows`` with ``out``: false only if the row's hash is not among the hashes of ``keys``.

    The hashes set bits of a bitmap of fixed size, which is broadcast; where many bits are set, more rows are marked than need be.
    """
    place = lambda h: F.pmod(h, F.lit(SET_BITS))
    bits = (keys.select(place(key_hash).alias("_at")).groupBy(F.expr("_at div 32768").cast("int").alias("_part"))
            .agg(F.bitmap_construct_agg(F.expr("_at % 32768")).alias("_bits")))
    at = rows.withColumn("_at", place(hashed)).withColumn("_part", F.expr("_at div 32768").cast("int"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at % 32768 div 8 + 1 AS int), 1)")), 16, 10).cast("int")
    found = F.getbit(byte, F.expr("cast(_at % 8 AS int)")) == 1
    return at.join(F.broadcast(bits), "_part", "left").withColumn(out, F.coalesce(found, F.lit(False))).select(*map(quoted, rows.columns), out)
