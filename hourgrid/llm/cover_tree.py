"""Embedding near-duplicates by dual traversal of cover trees.

Unit vectors with cosine >= c are at most tau = sqrt(2 - 2c) apart. A cover tree
has nested levels whose radii halve: every node's members lie within its covering
radius of its centre. Two nodes are walked together and dropped when their centres
are further apart than tau plus both radii; when even centre distance plus both
radii is within tau, all their members link and are counted without being listed;
pairs of leaves are compared exactly.

On the cluster the top level is a cover by pivots, taken from at most ``SAMPLE``
vectors; every vector goes to its nearest pivot and the covering radii are measured
over all vectors, so the sample decides speed alone. Cells are cut into blocks of
about ``BLOCK`` vectors. Pairs of blocks of a label that pass the radius bound are
groups; a group builds the lower levels of both blocks and returns link counts and
a spanning forest, never the pairs. Equal vectors are one vector with a count.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, or whose label is null, link with nothing; vectors of unlike length
don't link; repeated rows link with each other, and all rows with the smallest id
are kept; a null id is kept only if no vector reachable has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import read
from hourgrid.llm.components import connected_components, find, unite, with_component
from hourgrid.session import materialize

COSINE, BLOCK, SAMPLE, SAMPLE_BYTES = 0.93, 2048, 20_000, 32 << 20
#: Tasks over which the pairs of blocks of one label are made.
DEALS = 16
#: A node of so few members is a leaf; the net of a node is found in tiles of so many members.
LEAF, TILE = 12, 256
_SLACK = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of norm 1 in double precision (scaled first, so squares don't overflow)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _apart(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))


class Node:
    __slots__ = ("centre", "radius", "members", "children")

    def __init__(self, centre, radius, members, children):
        self.centre, self.radius, self.members, self.children = centre, radius, members, children


def _net(x: np.ndarray, members: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
    """Greedy cover of the members by balls: (members, covering radius), centre first."""
    centres: list[int] = []
    owner, dist = np.empty(len(members), dtype=np.int64), np.empty(len(members))
    for a in range(0, len(members), TILE):
        tile = members[a:a + TILE]
        at = np.arange(a, a + len(tile))
        free = np.ones(len(tile), dtype=bool)
        if centres:
            d = _apart(x[tile] @ x[centres].T)
            best = d.argmin(axis=1)
            near = d[np.arange(len(tile)), best]
            got = near <= radius
            owner[at[got]], dist[at[got]], free = best[got], near[got], ~got
        inner = _apart(x[tile] @ x[tile].T)
        for i in range(len(tile)):
            if free[i]:
                mine = free & (inner[i] <= radius)
                mine[i] = True
                owner[at[mine]], dist[at[mine]] = len(centres), inner[i][mine]
                dist[at[i]] = 0.0
                free &= ~mine
                centres.append(int(tile[i]))
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
    out = []
    for k, c in enumerate(centres):
        mine = order[cuts[k]:cuts[k + 1]]
        own = members[mine]
        out.append((np.concatenate([[c], own[own != c]]), float(dist[mine].max())))
    return out


def build(x: np.ndarray, members: np.ndarray | None = None, radius: float = 2.0) -> Node:
    """Cover tree of rows of norm 1; levels have radii 2, 1, 1/2, ..."""
    members = np.arange(len(x)) if members is None else members
    root = Node(int(members[0]), float(_apart(x[members] @ x[members[0]]).max()), members, [])
    todo = [(root, radius)]
    while todo:
        node, r = todo.pop()
        while len(node.members) > LEAF and r >= 1e-6 and r / 2 >= node.radius:
            r /= 2  # a level that this node covers alone; members in one point (radius 0) end as a leaf
        if len(node.members) <= LEAF or r < 1e-6:
            continue
        node.children = [Node(int(m[0]), d, m, []) for m, d in _net(x, node.members, r / 2)]
        todo += [(c, r / 2) for c in node.children]
    return root


class Links:
    """Counts and a forest of the links between rows of x and rows of y (the same rows if ``own``)."""

    def __init__(self, x: np.ndarray, wx: np.ndarray, y: np.ndarray | None, wy: np.ndarray | None, cosine: float):
        self.own = y is None
        self.x, self.wx = x, wx
        self.y, self.wy = (x, wx) if y is None else (y, wy)
        self.off = 0 if self.own else len(x)
        self.count = np.zeros(len(x) + (0 if self.own else len(y)), dtype=np.int64)
        self.parent = np.arange(len(self.count))
        self.cosine, self.tau = cosine, float(np.sqrt(2 - 2 * cosine))

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links between single rows."""
        np.add.at(self.count, i, self.wy[j])
        np.add.at(self.count, j + self.off, self.wx[i])
        unite(self.parent, i, j + self.off)

    def every(self, a: Node, b: Node) -> None:
        """All members of a link with all of b."""
        if a is b:
            total = self.wx[a.members].sum()
            self.count[a.members] += total - self.wx[a.members]
            unite(self.parent, a.members, np.full(len(a.members), a.centre))
            return
        self.count[a.members] += self.wy[b.members].sum()
        self.count[b.members + self.off] += self.wx[a.members].sum()
        both = np.concatenate([a.members, b.members + self.off])
        unite(self.parent, both, np.full(len(both), a.centre))

    def leaves(self, a: Node, b: Node) -> None:
        near = self.x[a.members] @ self.y[b.members].T >= self.cosine
        if a is b:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if len(i):
            self.pairs(a.members[i], b.members[j])

    def walk(self, a: Node, b: Node) -> None:
        """Traverse node pairs from (a, b) on."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a is b and 2 * a.radius <= self.tau - 1e-6:
                self.every(a, a)
                continue
            if not a.children and not b.children:
                self.leaves(a, b)
                continue
            ca, cb = a.children or [a], b.children or [b]
            ra, rb = np.array([n.radius for n in ca]), np.array([n.radius for n in cb])
            na, nb = (np.array([len(n.members) for n in c]) for c in (ca, cb))
            ia, ib = np.array([n.centre for n in ca]), np.array([n.centre for n in cb])
            for k in range(0, len(ca), 1024):  # bounds the matrix of centre distances
                part = slice(k, k + 1024)
                dots = self.x[ia[part]] @ self.y[ib].T
                far = _apart(dots)
                reach = ra[part, None] + rb[None, :]
                alive = far <= self.tau + reach + _SLACK
                if a is b:
                    alive &= np.arange(len(ca))[part, None] <= np.arange(len(cb))[None, :]
                single = (na[part, None] == 1) & (nb[None, :] == 1)
                hit = alive & single & (dots >= self.cosine)
                if a is b:
                    hit &= np.arange(len(ca))[part, None] != np.arange(len(cb))[None, :]
                i, j = np.nonzero(hit)
                if len(i):
                    self.pairs(ia[i + k], ib[j])
                for i, j in zip(*np.nonzero(alive & ~single)):
                    u, v = ca[i + k], cb[j]
                    if u is not v and far[i, j] + reach[i, j] <= self.tau - 1e-6:
                        self.every(u, v)
                    else:
                        stack.append((u, v))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def _distinct(vectors: DataFrame) -> DataFrame:
    """Valid vectors once each: uid, label, dim, vec, n (copies), least (smallest id)."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = vectors.where("label IS NOT NULL AND vec IS NOT NULL").where(~bad & F.exists("vec", lambda x: x != 0))
    once = valid.groupBy("label", "key", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    return materialize(once.select(F.monotonically_increasing_id().alias("uid"), "label", F.size("vec").alias("dim"), "key", "vec", "n", "least"),
                       "cover-vectors")


def _pivots(vectors: DataFrame, block: int, sample: int) -> dict:
    """Per (label, dim) the centres of the top level: a farthest-first cover of its share of the sample."""
    counts = vectors.groupBy("label", "dim").count().where(F.col("count") > block)
    # labels of one block need no pivots; the sample is bounded in rows and bytes whatever the number of labels and dimensions
    widest = counts.agg(F.max("dim")).first()[0]
    sample = min(sample, SAMPLE_BYTES // (8 * max(widest or 1, 1)))
    some = vectors.join(counts, ["label", "dim"], "left_semi").orderBy(F.xxhash64("uid")).limit(sample)
    rows = some.select("label", "dim", "uid", "vec").orderBy("label", "dim", "uid").collect()
    sizes = {(r["label"], r["dim"]): r["count"] for r in counts.join(F.broadcast(some.select("label", "dim").distinct()), ["label", "dim"], "left_semi").collect()}
    held: dict = {}
    for r in rows:
        held.setdefault((r["label"], r["dim"]), []).append(r["vec"])
    out = {}
    for key, vecs in held.items():
        x = unit(np.array(vecs, dtype=np.float64))
        want = min(len(x), -(-sizes[key] // block))
        chosen, far = [0], _apart(x @ x[0])
        while len(chosen) < want and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _apart(x @ x[chosen[-1]]))
        out[key] = x[chosen]
    return out


def cover_links(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(uid, root, links) partial results of the groups over a stored table of distinct vectors."""
    spark = vectors.sparkSession
    pivots = spark.sparkContext.broadcast(_pivots(vectors, block, sample))
    rows = vectors.select("uid", "label", "dim", "vec", "n")
    kind = rows.schema["label"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            cell, dist = np.zeros(batch.num_rows, dtype=np.int64), np.full(batch.num_rows, 2.0)
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            of: dict = {}
            for i, key in enumerate(keys):
                of.setdefault(key, []).append(i)
            for key, at in of.items():
                if key in pivots.value:
                    x = unit(_matrix(batch.column(3).take(pa.array(at))))
                    d = _apart(x @ pivots.value[key].T)
                    cell[at] = d.argmin(axis=1)
                    dist[at] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(dist)], names=[*batch.schema.names, "cell", "dist"])

    placed = materialize(rows.mapInArrow(place, f"uid long, label {kind}, dim int, vec {rows.schema['vec'].dataType.simpleString()}, n long, cell long, dist double"),
                         "cover-cells")
    cells = placed.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("size"), F.max("dist").alias("radius"))
    cells = cells.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    names = ["label", "dim", "cell"]
    centres = [(i, *key, c, v.tolist()) for i, (key, x) in enumerate(pivots.value.items()) for c, v in enumerate(x)]
    if centres:
        # as many rows as the sample at most
        known = spark.createDataFrame(centres, f"_i int, label {kind}, dim int, cell long, centre array<double>").drop("_i")
        cells = cells.join(F.broadcast(known), names, "left")
    else:
        cells = cells.withColumn("centre", F.lit(None).cast("array<double>"))
    blocks = materialize(cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))), "cover-blocks")
    later = (F.col("a.cell") < F.col("b.cell")) | ((F.col("a.cell") == F.col("b.cell")) & (F.col("a.part") <= F.col("b.part")))
    dots = F.aggregate(F.zip_with("a.centre", "b.centre", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    gap = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dots))
    tau = float(np.sqrt(2 - 2 * cosine))
    near = F.col("a.centre").isNull() | F.col("b.centre").isNull() | (gap <= F.col("a.radius") + F.col("b.radius") + tau + 1e-6)
    # a label may have many blocks: one side is dealt by its cell, and the other is copied to every deal
    a = blocks.withColumn("deal", F.pmod(F.xxhash64("cell", "part"), F.lit(DEALS)).cast("int")).alias("a")
    b = blocks.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1)))).alias("b")
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.deal") == F.col("b.deal"))
    pairs = (a.join(b, same).where(later & near)
             .select(F.col("a.label").alias("label"), F.col("a.dim").alias("dim"), F.col("a.cell").alias("ca"), F.col("a.part").alias("pa"),
                     F.col("b.cell").alias("cb"), F.col("b.part").alias("pb"), F.monotonically_increasing_id().alias("pair")))
    pairs = materialize(pairs, "cover-pairs")
    own = (F.col("ca") == F.col("cb")) & (F.col("pa") == F.col("pb"))
    sides = pairs.select("label", "dim", F.col("ca").alias("cell"), F.col("pa").alias("part"), "pair", F.lit(0).alias("side")).unionByName(
        pairs.where(~own).select("label", "dim", F.col("cb").alias("cell"), F.col("pb").alias("part"), "pair", F.lit(1).alias("side")))
    parts = cells.select(*names, "blocks")
    cut = placed.join(parts, names).withColumn("part", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    dealt = cut.join(sides, [*names, "part"]).select("pair", "side", "uid", "vec", "n")

    def meet(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        x, n, uid = unit(_matrix(table.column("vec"))), table.column("n").to_numpy(), table.column("uid").to_numpy()
        order = np.argsort(uid, kind="stable")
        one, two = order[side[order] == 0], order[side[order] == 1]
        if len(one) and len(two):
            links = Links(x[one], n[one], x[two], n[two], cosine)
            links.walk(build(links.x), build(links.y))
        elif len(one):
            links = Links(x[one], n[one], None, None, cosine)
            tree = build(links.x)
            links.walk(tree, tree)
        else:  # a block without rows meets nobody
            return pa.table({"uid": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        ids = uid[np.concatenate([one, two])]
        hit = links.count > 0
        root = find(links.parent, np.arange(len(links.parent)))
        return pa.table({"uid": ids[hit], "root": ids[root[hit]], "links": links.count[hit]})

    return dealt.groupBy("pair").applyInArrow(meet, "uid long, root long, links long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("vec"), F.col(f"`{label_col}`").alias("label"))
    rows = rows.withColumn("key", F.xxhash64("vec"))
    once = _distinct(rows)
    part = materialize(cover_links(once, cosine, block), "cover-links")
    counts = part.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = connected_components(part.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    least = materialize(once.join(roots, once.uid == roots.node).select("uid", "root", "least"), "cover-roots")
    grouped = with_component(least, "root", "least", "component").select("uid", "component", F.lit(True).alias("_in"))
    found = once.join(counts, "uid", "left").join(grouped, "uid", "left").select(
        "label", "key", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("_in"), F.col("component")).otherwise(F.col("least")).alias("component"), F.lit(True).alias("_found"))
    found = materialize(found, "cover-found")
    placed = rows.join(found, ["label", "key", "vec"], "left")
    component = F.when(F.col("_found"), F.col("component")).otherwise(F.col("vec_id"))
    return placed.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
