"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are keys of a binary trie. The join walks pairs of trie nodes from
the root: children with the same bit keep the pair's count of differing bits,
children with different bits add one, and a pair over the bit budget is pruned
with everything below it. Small pairs of subtrees are compared directly.

On the cluster the top of the trie is cut into leaves of at most ``LEAF``
distinct fingerprints (or 1/16384 of all), heavier prefixes being cut deeper. The
walk over the leaves' trie gives the pairs of leaves that can hold a link; a leaf
and a few of its near leaves are one group, which continues the walk and returns
a spanning forest of its links, never the pairs themselves. Components follow from the
forests. Copies share a fingerprint and are one key.

Defined results: a null or empty text, or one of white space, has fingerprint
zero, linked like any other; rows with the same id are rows of their own and
share the component of their fingerprints; ``component_id`` is the smallest id
reachable, null only if no row reachable has an id. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hourgrid.llm.common import read
from hourgrid.llm.components import connected_components, find, unite, with_component
from hourgrid.session import materialize

SHINGLE, BITS = 3, 2
LEAF, LEAVES, STEP = 100_000, 16_384, 4
#: Leaves that are near one leaf and meet it in the same group.
NEAR_LEAVES = 4
#: Node pairs walked at once, and the most comparisons a node pair may hold to be compared directly.
FRONTIER, DIRECT = 100_000, 32
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned integer (0 without words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    n = max(1, len(words) - shingle + 1)
    starts, stops = [0, *ends[:n - 1]], ends[len(words) - n:]
    hashed, votes = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, _BLOCK):
        part = [hashed(joined[i:j - 1], 42) for i, j in zip(starts[k:k + _BLOCK], stops[k:k + _BLOCK])]
        rows = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``out`` (replacing one of that name)."""
    docs = docs.select(*[c for c in docs.columns if c != out])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, LongType())]))


def _spread(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, position) for every position of the ranges [lo, lo + size)."""
    which = np.repeat(np.arange(len(lo)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)


def trie_links(a: np.ndarray, b: np.ndarray | None, bits: int = BITS):
    """Yield (positions in a, positions in b) of links between sorted distinct uint64 keys.

    ``b`` None: a is joined with itself, each pair once.
    """
    own, b = b is None, a if b is None else b
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], dtype=np.int64))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(depth, pairs[:half]), (depth, pairs[half:])]
            continue
        alo, ahi, blo, bhi, err = pairs.T
        done = (ahi - alo) * (bhi - blo) <= DIRECT if depth < 64 else np.ones(len(pairs), dtype=bool)
        if done.any():
            which, i = _spread(alo[done], (ahi - alo)[done])
            pair, j = _spread(blo[done][which], (bhi - blo)[done][which])
            i = i[pair]
            near = np.bitwise_count(a[i] ^ b[j]) <= bits
            if own:
                near &= i < j
            yield i[near], j[near]
        pairs = pairs[~done]
        if not len(pairs):
            continue
        alo, ahi, blo, bhi, err = pairs.T
        bit = np.uint64(1 << (63 - depth))
        keep = np.uint64((~((1 << (64 - depth)) - 1)) & (2**64 - 1))
        amid = np.clip(np.searchsorted(a, (a[alo] & keep) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(b, (b[blo] & keep) | bit), blo, bhi)
        same = (alo == blo) & (ahi == bhi) if own else np.zeros(len(pairs), dtype=bool)
        nxt = [np.stack(x, axis=1) for x in (
            (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
            (amid[~same], ahi[~same], blo[~same], bmid[~same], err[~same] + 1))]
        pairs = np.concatenate(nxt)
        alive = (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & (pairs[:, 4] <= bits)
        if alive.any():
            stack.append((depth + 1, pairs[alive]))


def _cut(keys: DataFrame, total: int, most: int) -> list[tuple[int, int]]:
    """Leaves (depth, prefix) of the top trie, in key order; the driver sees only counts of prefixes.

    Heavy prefixes number at most total / most, and each is cut by ``STEP`` bits a round.
    """
    leaves, heavy, depth = [], {0: total}, 0
    while heavy:
        if depth == 64 or max(heavy.values()) <= most:
            leaves += [(depth, p) for p in heavy]
            break
        step = min(STEP, 64 - depth)
        low = 64 - depth - step
        held = keys
        if depth:
            nodes = keys.sparkSession.createDataFrame([(p - (1 << depth) if p >> (depth - 1) else p,) for p in heavy], "p long")
            held = keys.join(F.broadcast(nodes), F.shiftright("fp", 64 - depth) == F.col("p"), "left_semi")
        counts = {p % (1 << (depth + step)): n for p, n in held.groupBy(F.shiftright("fp", low)).count().collect()}
        for d in range(depth + step - 1, depth - 1, -1):  # counts of the inner nodes
            width = depth + step - d
            for p, n in [(p, n) for p, n in counts.items() if isinstance(p, int)]:
                counts[d, p >> width] = counts.get((d, p >> width), 0) + n
        walk, heavy_next = [(depth, p) for p in heavy], {}
        while walk:
            d, p = walk.pop()
            n = counts.get(p if d == depth + step else (d, p), 0)
            if n <= most:
                leaves.append((d, p))
            elif d == depth + step:
                heavy_next[p] = n
            else:
                walk += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        heavy, depth = heavy_next, depth + step
    return sorted(leaves, key=lambda x: x[1] << (64 - x[0]))


def _leaf_pairs(leaves: list[tuple[int, int]], bits: int) -> list[tuple[int, int]]:
    """Pairs of leaves whose prefixes differ in at most ``bits`` of the bits that both have."""
    inner, index = set(), {x: i for i, x in enumerate(leaves)}
    for d, p in leaves:
        inner.update((d - k, p >> k) for k in range(1, d + 1))
    found, walk = [], [((0, 0), (0, 0))]
    while walk:
        x, y = walk.pop()
        if x in index and y in index:
            found.append((index[x], index[y]))
            continue
        xs = [x] if x in index else [(x[0] + 1, 2 * x[1] + k) for k in (0, 1)]
        ys = [y] if y in index else [(y[0] + 1, 2 * y[1] + k) for k in (0, 1)]
        for u in xs:
            for v in ys:
                if x == y and u > v:
                    continue
                k = min(u[0], v[0])  # a leaf may end above the other node
                if ((u[1] >> (u[0] - k)) ^ (v[1] >> (v[0] - k))).bit_count() <= bits:
                    walk.append((u, v))
    return found


def trie_forest(keys: DataFrame, total: int, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span every group of near ones."""
    leaves = _cut(keys, total, max(leaf, total // LEAVES))
    pairs = _leaf_pairs(leaves, bits)
    starts = np.array([p << (64 - d) for d, p in leaves], dtype=np.uint64)
    near = [[] for _ in leaves]
    for i, j in pairs:
        if i != j:
            near[min(i, j)].append(max(i, j))
    # a leaf meets its later near leaves a few at a time; the first such group also joins it with itself
    cells, first_cells = [[] for _ in leaves], set()
    n = 0
    for i, others in enumerate(near):
        for k in range(0, max(1, len(others)), NEAR_LEAVES):
            cells[i].append((n, 0))
            for j in others[k:k + NEAR_LEAVES]:
                cells[j].append((n, 1))
            if not k:
                first_cells.add(n)
            n += 1
    first = np.cumsum([0] + [len(x) for x in cells])
    flat = np.array([y for x in cells for y in x], dtype=np.int64).reshape(-1, 2)

    def deal(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, fps.view(np.uint64), side="right") - 1
            which, pos = _spread(first[at], first[at + 1] - first[at])
            yield pa.RecordBatch.from_arrays([pa.array(flat[pos, 0]), pa.array(flat[pos, 1].astype(np.int8)), pa.array(fps[which])],
                                             names=["cell", "side", "fp"])

    def join(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = np.sort(fps[side == 0]), np.sort(fps[side == 1])
        both = np.concatenate([a, b])
        parent = np.arange(len(both))
        if table.column("cell")[0].as_py() in first_cells:
            for i, j in trie_links(a, None, bits):
                unite(parent, i, j)
        if len(a) and len(b):
            for i, j in trie_links(a, b, bits):
                unite(parent, i, j + len(a))
        root = find(parent, parent)
        linked = root != np.arange(len(both))
        return pa.table({"a": both[linked].view(np.int64), "b": both[root[linked]].view(np.int64)})

    dealt = keys.select("fp").mapInArrow(deal, "cell long, side byte, fp long")
    return dealt.groupBy("cell").applyInArrow(join, "a long, b long")


def near_groups(fps: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of a stored table (doc_id, fp).

    ``root`` is the smallest fingerprint (signed) of the group, ``component_id`` its smallest id.
    """
    keys = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-keys")
    roots = connected_components(trie_forest(keys, keys.count(), bits, leaf))
    linked = materialize(keys.join(roots, keys.fp == roots.node).select("fp", "root", "least"), "simhash-roots")
    near = materialize(with_component(linked, "root", "least", "component_id").select("fp", "root", "component_id"), "simhash-linked")
    return keys.join(near, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    fps = materialize(with_fingerprint(texts, "text", shingle).select("doc_id", "fp"), "simhash")
    groups = materialize(near_groups(fps, bits, leaf), "simhash-groups")
    return fps.join(groups, "fp", "left").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id, ties by fingerprint.

    Rows equal in id and fingerprint are one document. Rows without an id are
    kept only from groups in which no row has one.
    """
    names = docs.columns
    packed = docs.select(F.struct("*").alias("row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    wide = materialize(with_fingerprint(packed, "text", shingle).drop("text"), "simhash-rows")
    groups = near_groups(wide.select("doc_id", "fp"), bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first")
    reps = wide.select("doc_id", "fp").distinct().join(groups.select("fp", "root"), "fp").groupBy("root").agg(first)
    reps = materialize(reps.select(F.col("first.doc_id").alias("rep_id"), F.col("first.fp").alias("rep_fp")), "simhash-kept")
    # one key that is never null, so that the join and the removal of equal rows share one exchange of the texts
    kept = wide.withColumn("key", F.struct("doc_id", "fp")).join(
        reps.select(F.struct(F.col("rep_id").alias("doc_id"), F.col("rep_fp").alias("fp")).alias("key")), "key", "left_semi")
    return kept.dropDuplicates(["key"]).select(*[F.col("row")[c].alias(c) for c in names])


def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))
