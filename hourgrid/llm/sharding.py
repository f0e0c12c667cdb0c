"""Shards by a hierarchical weighted hash tree (law ``key``).

The tree has region, rack and shard levels. At each level every child draws
``ln(u) / weight`` with u hashed from (key, node); the largest draw wins, so a
child is chosen in proportion to its weight. A weight change moves rows only
into or out of the subtree it belongs to: the draws of all other nodes stay.

The layout of ``base`` shards is fixed; each shard beyond it opens a region of
its own. One more shard therefore adds one draw at the top level and takes rows
only into itself.

Defined results: a null key is hashed as a key of its own, so all its rows
share a shard; a null text has size 8 and the CRC of the empty text; repeated
rows share a shard and get slots of their own; an empty table gives no rows.
Columns of the input other than the key and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import key_text, md5_int, read
from hourgrid.session import materialize

SHARDS, BASE, PER_RACK, RACKS = 24, 24, 2, 3
ROWS_PER_BLOCK = 1_000_000
#: Slots of equal rows are made in arrays of at most so many.
COPY_BLOCK = 100_000


@dataclass(frozen=True)
class Topology:
    """regions[r][k] lists the (shard, weight) pairs of rack k of region r."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def of(cls, shards: int, base: int = BASE, racks: int = RACKS, per_rack: int = PER_RACK) -> Topology:
        """``base`` shards in full regions; each further shard is a region of its own."""
        ids = list(range(min(shards, base)))
        rack = [tuple((i, 1.0) for i in ids[a:a + per_rack]) for a in range(0, len(ids), per_rack)]
        regions = [tuple(rack[a:a + racks]) for a in range(0, len(rack), racks)]
        return cls(tuple(regions) + tuple((((i, 1.0),),) for i in range(base, shards)))


def _draw(key: Column, node: Column, weight: Column) -> Column:
    u = (md5_int(F.concat(key, F.lit("/"), node)).cast("double") + 0.5) / float(1 << 52)
    return F.when(weight > 0, F.ln(u) / weight)


def _best(key: Column, prefix: Column, weights: list[Column]) -> Column:
    """Index of the child with the largest draw (ties: the larger index)."""
    draws = []
    for i, w in enumerate(weights):
        d = _draw(key, F.concat(prefix, F.lit(f"{i}")), w)
        draws.append(F.when(d.isNotNull(), F.struct(d.alias("d"), F.lit(i).alias("i"))))
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["i"]


def _at(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _descend(df: DataFrame, tree: Topology, out: str) -> DataFrame:
    """Add column ``out``: the shard that the tree gives to ``_key``."""
    racks = max(len(r) for r in tree.regions)
    width = max(len(k) for r in tree.regions for k in r)
    region_w = [sum(w for k in r for _, w in k) for r in tree.regions]
    rack_w = [float(sum(w for _, w in r[k])) if k < len(r) else 0.0 for r in tree.regions for k in range(racks)]
    leaf = [(r[k][s] if k < len(r) and s < len(r[k]) else (-1, 0.0))
            for r in tree.regions for k in range(racks) for s in range(width)]
    key = F.col("_key")
    df = df.withColumn("_r", _best(key, F.lit("r"), [F.lit(w) for w in region_w]))
    r = F.col("_r")
    df = df.withColumn("_k", _best(key, F.concat(F.lit("r"), r.cast("string"), F.lit("k")),
                                   [_at(rack_w, r * racks + k) for k in range(racks)]))
    slot = (r * racks + F.col("_k")) * width
    name = F.concat(F.lit("r"), r.cast("string"), F.lit("k"), F.col("_k").cast("string"), F.lit("s"))
    best = _best(key, name, [_at([w for _, w in leaf], slot + s) for s in range(width)])
    return df.withColumn(out, _at([i for i, _ in leaf], slot + best)).drop("_r", "_k")


def with_shard(docs: DataFrame, key_col: str, shards: int = SHARDS, base: int = BASE, out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row, without a shuffle (e.g. for ``partitionBy``)."""
    kept = [docs[c] for c in docs.columns if c not in (out, "_key")]
    keyed = docs.select(*kept, key_text(docs[key_col]).alias("_key"))
    return _descend(keyed, Topology.of(shards, base), out).drop("_key")


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                  base: int = BASE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    Slots are gapless from 0 in each shard. A shard is numbered in hash blocks of
    about ``rows_per_block`` rows: blocks are ranked on their own and shifted by
    the counts of the blocks before, so no task holds a shard. Equal rows are
    counted before the shuffle and spread again after it; rows of one key with other content fall into blocks of their own.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), key_text(docs[id_col]).alias("_key"))
    rows = _descend(rows, Topology.of(shards, base), "shard")
    rows = _descend(rows, Topology.of(shards + 1, base), "grown_shard")
    groups = rows.groupBy("doc_id", "size", "text_crc32", "_key", "shard", "grown_shard").agg(F.count(F.lit(1)).alias("n"))
    groups = materialize(groups, "shard-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // (rows_per_block * shards)))
    # rows of one key, or without one, spread over the blocks by their content
    content = F.concat_ws("/", F.lit("slot"), F.col("_key"), F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    groups = groups.withColumn("_block", F.pmod(md5_int(content, 8), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (groups.groupBy("shard", "_block").agg(F.sum("n").alias("_n"))
              .select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = (Window.partitionBy("shard", "_block").orderBy("doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = groups.withColumn("_first", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = ranked.join(starts, ["shard", "_block"])
    # a group's slots are dealt in two steps: no array holds more than COPY_BLOCK of them
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPY_BLOCK).cast("long")))
    first = F.col("_start") + F.col("_first")
    dealt = placed.select("doc_id", "size", "text_crc32", "shard", "grown_shard", first.alias("_from"), (first + F.col("n") - 1).alias("_to"), part.alias("_part"))
    low = F.col("_from") + F.col("_part") * COPY_BLOCK
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(low, F.least(F.col("_to"), low + COPY_BLOCK - 1))).alias("slot"), "grown_shard",
    )


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))
