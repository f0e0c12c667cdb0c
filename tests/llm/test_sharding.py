import hashlib
import math
import zlib
from collections import Counter

from hourgrid.llm import sharding


def brute_shard(key, shards):
    """Walk the tree in plain Python."""
    tree = sharding.Topology.of(shards).regions

    def best(prefix, weights):
        draws = []
        for i, w in enumerate(weights):
            u = (int(hashlib.md5(f"{key}/{prefix}{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            draws.append((math.log(u) / w, i))
        return max(draws)[1]

    r = best("r", [sum(w for k in x for _, w in k) for x in tree])
    k = best(f"r{r}k", [sum(w for _, w in x) for x in tree[r]])
    return tree[r][k][best(f"r{r}k{k}s", [w for _, w in tree[r][k]])][0]


def test_query_matches_brute_force(spark, sf, texts):
    rows = sharding.op4_hash_tree_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.shard == brute_shard(r.doc_id, 24) and r.grown_shard == brute_shard(r.doc_id, 25)
    slots = Counter((r.shard, r.slot) for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert set(slots) == {(s, i) for s, n in sizes.items() for i in range(n)} and max(slots.values()) == 1


def test_growth_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    for n in (24, 25, 26, 29):
        a = {r.doc_id: r.shard for r in sharding.with_shard(ids, "doc_id", n).collect()}
        b = {r.doc_id: r.shard for r in sharding.with_shard(ids, "doc_id", n + 1).collect()}
        moved = [k for k in a if a[k] != b[k]]
        assert {b[k] for k in moved} == {n} and 0.5 < len(moved) * (n + 1) / 20000 < 1.5
    spread = Counter(a.values())
    assert len(spread) == 29 and max(spread.values()) < 1.3 * 20000 / 29


def test_a_weight_change_stays_in_its_subtree(spark):
    ids = spark.range(6000).select("id", sharding.key_text(sharding.F.col("id")).alias("_key"))
    base = sharding.Topology.of(24)
    heavier = sharding.Topology((tuple(tuple((i, 3.0 if i == 0 else w) for i, w in k) for k in base.regions[0]), *base.regions[1:]))
    a = {r.id: r.s for r in sharding._descend(ids, base, "s").collect()}
    b = {r.id: r.s for r in sharding._descend(ids, heavier, "s").collect()}
    # rows either stay or move towards the heavier region (shards 0 to 5)
    assert all(b[k] < 6 for k in a if a[k] != b[k]) and any(a[k] != b[k] for k in a)


def test_edges(table):
    df = table([(1, None, "s"), (None, "x", "s"), (None, "yy", None), (7, "é", "s")] + [(9, "same", "s")] * 50)
    rows = sharding.assign_shards(df, rows_per_block=1).collect()
    assert len(rows) == 54 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {(r.doc_id, r.size) for r in rows} == {(1, 8), (None, 9), (None, 10), (7, 10), (9, 12)}
    by: dict = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.assign_shards(df.limit(0)).count() == 0
    kept = sharding.with_shard(df, "doc_id")
    assert kept.count() == 54 and kept.columns == [*(c for c in df.columns if c != "_key"), "shard"]
