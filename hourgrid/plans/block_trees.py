"""Spark ML's boosted regression trees on packed rows (M1, M3).

The trees are those of ``GBTRegressor`` with squared loss: the same candidate splits from the same sampled rows, the same
gains, the first tree on the label and the others on what is left of it. Only the layout differs:

1. A row's features become the numbers of their bins, and features share a number while it stays small. A few bytes a
   row, its label and its prediction (or what is left of the label) are kept in blocks of rows, in memory or on disk
   as there is room.
2. A level of a tree is one pass: each task sums rows and residuals per (node, feature, bin) with numpy. Of two
   large children only the smaller is summed, the other is what its parent has besides.
3. A finished tree moves the predictions, in the pass that sums the next tree's root; the old blocks are given up.

Only sums leave the tasks; the driver sees some kilobytes per node and task, or per node when there are many tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["BlockTrees", "fit_blocks", "fits_blocks"]

#: Rows of a block, rows that a task passes over (some 30 bytes each), cells that features share, tasks from which sums are added up before the driver.
BLOCK, TASK_ROWS, CELLS, GATHER = 32_768, 1_000_000, 1024, 64
#: Nodes of at most so many rows are summed and split in Spark ML's own order and arithmetic; fits of more rows keep residuals in place of labels and predictions.
EXACT_ROWS, EXACT_FIT = 65_536, 1_000_000
DEFAULTS = {"maxIter": 20, "maxDepth": 5, "maxBins": 32, "stepSize": 0.1, "minInstancesPerNode": 1, "minInfoGain": 0.0, "seed": 10, "lossType": "squared"}
#: Gains this close (as a share) are equal: the first feature and bin count.
TIE, EPSILON = 1e-12, 2.220446049250313e-16


def fits_blocks(params: Mapping[str, Any] | None) -> bool:
    """Whether :func:`fit_blocks` knows the parameters of a ``GBTRegressor``."""
    p = {**DEFAULTS, **(params or {})}
    return set(p) == set(DEFAULTS) and p["lossType"] == "squared" and p["maxBins"] <= CELLS and p["maxDepth"] <= 10


class _Layout(NamedTuple):
    """Where the bins of a feature are: (feature, code, stride, bins) of each feature that has a split, and the cells of each code."""

    place: list[tuple[int, int, int, int]]
    cells: list[int]
    n_bins: int

    @staticmethod
    def of(edges: list[np.ndarray]) -> _Layout:
        place, cells = [], []
        for f in sorted((f for f in range(len(edges)) if len(edges[f])), key=lambda f: (-len(edges[f]), f)):
            bins = len(edges[f]) + 1
            code = next((c for c, n in enumerate(cells) if n * bins <= CELLS), len(cells))
            if code == len(cells):
                cells.append(1)
            place.append((f, code, cells[code], bins))
            cells[code] *= bins
        return _Layout(sorted(place), cells, sum(p[-1] for p in place))

    def spans(self) -> list[tuple[int, int, int]]:
        """(feature, start, end) of each feature's bins in the sums."""
        ends = np.cumsum([p[-1] for p in self.place]).tolist()
        return [(p[0], e - p[-1], e) for p, e in zip(self.place, ends)]

    def goes_right(self, feature: int, bin_: int) -> tuple[int, np.ndarray]:
        """The code of a feature, and per cell whether the feature is beyond the bin."""
        code, stride, bins = next(p[1:] for p in self.place if p[0] == feature)
        right = np.zeros(max(self.cells), dtype=np.uint8)
        right[:self.cells[code]] = np.arange(self.cells[code]) // stride % bins > bin_
        return code, right


@dataclass
class _Tree:
    """Levels of (feature, threshold) per node, a leaf going left for ever, and the values of the last level's nodes."""

    levels: list[tuple[np.ndarray, np.ndarray]]
    values: np.ndarray
    gains: dict[int, float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, row = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for feature, threshold in self.levels:
            node = 2 * node + (x[row, feature[node]] > threshold[node])
        return self.values[node]


@dataclass
class BlockTrees:
    """The fitted trees, as a stage of a pipeline model: reads ``_features``, adds ``preds``."""

    trees: list[_Tree]
    weights: list[float]
    n_features: int

    @property
    def featureImportances(self):  # noqa: N802 - as Spark ML names it
        from pyspark.ml.linalg import Vectors

        total = np.zeros(self.n_features)
        for t in self.trees:
            for f, gain in t.gains.items():
                total[f] += gain
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        trees, weights, n = self.trees, self.weights, self.n_features

        @F.arrow_udf("double")
        def preds(features: pa.Array) -> pa.Array:
            x = features.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            out = np.zeros(len(x))
            for t, w in zip(trees, weights):
                out += w * t.predict(x)
            return pa.array(out)

        return dataset.withColumn("preds", preds(vector_to_array(F.col("_features"))))


def fit_blocks(rows: DataFrame, features: Sequence[str], label: str, n_rows: int, params: Mapping[str, Any] | None = None) -> BlockTrees:
    """Fit the trees of ``GBTRegressor(**params)`` to the ``n_rows`` rows, whose features (doubles) have no missing value."""
    p = {**DEFAULTS, **(params or {})}
    if not n_rows:
        raise ValueError("no training rows")
    edges = _candidates(rows, features, n_rows, p["maxBins"], p["seed"])
    layout = _Layout.of(edges)
    tasks = max(-(-n_rows // TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    packed = rows.select(*features, F.col(label).cast("double").alias("_label")).coalesce(tasks).mapInArrow(_pack(layout, edges), "codes binary, label binary")
    blocks = packed.rdd.map(_first if n_rows <= EXACT_FIT else _first_residual).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    grow, trees, weights = _Growth(layout, edges, p, n_rows, tasks > GATHER), [], []
    old = None
    try:
        for i in range(p["maxIter"]):
            # Spark ML fits the later trees to the gradient, which is twice the residual
            scale, weight = (1.0, 1.0) if i == 0 else (2.0, p["stepSize"])
            tree, tables = grow.tree(blocks, old, scale)
            trees.append(tree)
            weights.append(weight)
            old, blocks = blocks, blocks.mapPartitions(_moved(tables, weight * tree.values)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    finally:
        for held in (old, blocks):
            if held is not None:
                held.unpersist()
    return BlockTrees(trees, weights, len(features))


def _candidates(rows: DataFrame, features: Sequence[str], n_rows: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of each feature by Spark ML's rule, from the rows that it samples: about 10,000, or ``max_bins`` squared if more."""
    wanted, splits = max(max_bins ** 2, 10_000), min(max_bins, n_rows) - 1
    share, found, spark = min(1.0, wanted / n_rows), rows.select(*features), rows.sparkSession
    if share < 1.0:
        number = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = found._jdf.toJavaRDD().sample(False, share, number)
        found = DataFrame(spark._jsparkSession.createDataFrame(sampled, found._jdf.schema()), spark)
    table = found.toArrow()
    return [_thresholds(table.column(i).to_numpy(), share * n_rows, splits) for i in range(len(features))]


def _thresholds(x: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """At most about ``splits`` thresholds between the values of ``x``; rows short of the ``expected`` number count as zeros (Spark ML's rule)."""
    values, counts = np.unique(x[x != 0.0], return_counts=True)
    missing, counts = expected - counts.sum(), counts.astype(np.float64)
    if missing > EPSILON * 100 * counts.sum():
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, missing)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= splits:
        return middle
    out, stride, done = [], expected / (splits + 1), counts[0]
    target = stride
    for i in range(1, len(values)):
        before, done = done, done + counts[i]
        if abs(before - target) < abs(done - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


# ---------------------------------------------------------------- tasks


def _pack(layout: _Layout, edges: list[np.ndarray]):
    """Rows to blocks."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        x = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]).astype(np.float64) for i in range(len(edges) + 1)]
        if not all(np.isfinite(v).all() for v in x):
            raise ValueError("a feature or the label of a training row is missing, NaN or infinite")
        codes = np.zeros((len(layout.cells), len(x[-1])), dtype=np.uint16)
        for f, code, stride, _ in layout.place:
            codes[code] += (stride * np.searchsorted(edges[f], x[f])).astype(np.uint16)
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (codes, x[-1])], names=["codes", "label"])

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) >= BLOCK:
                yield block(held)
                held = []
        if sum(h.num_rows for h in held):
            yield block(held)

    return run


def _first(row: Sequence[bytes]) -> tuple[bytes, bytes, bytes]:
    codes, label = map(bytes, row)
    return codes, label, bytes(len(label))


def _first_residual(row: Sequence[bytes]) -> tuple[bytes, bytes, bytes]:
    return *map(bytes, row), b""


def _read(block: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Codes, labels and predictions of a block, or codes, residuals and None."""
    codes, label, preds = (np.frombuffer(v, dtype=kind) for v, kind in zip(block, (np.uint16, np.float64, np.float64)))
    return codes.reshape(-1, len(label)), label, preds if len(preds) else None


def _routed(codes: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The node of each row after the levels of ``tables``."""
    node = np.zeros(n, dtype=np.int64)
    row, flat = np.arange(n), codes.ravel()
    for level, (code, right) in enumerate(tables):
        if level == 0:
            node = right[0].take(codes[code[0]]).astype(np.int64)
            continue
        cell = flat.take(code.take(node) * n + row)
        step = right.ravel().take(node * right.shape[1] + cell)
        node = 2 * node + step
    return node


class _Sums:
    """Rows and residuals per slot and bin of each feature, then rows, residuals and their squares per slot."""

    def __init__(self, layout: _Layout, slots: int):
        self.layout, self.slots, self.some = layout, slots, False
        self.count, self.total = ([np.zeros(slots * c) for c in layout.cells] for _ in range(2))
        self.whole = np.zeros((3, slots))

    def add(self, slot: np.ndarray, codes: Sequence[np.ndarray], resid: np.ndarray) -> None:
        n, self.some = self.slots, self.some or len(slot) > 0
        self.whole += [np.bincount(slot, w, n) for w in (None, resid, resid * resid)]
        for k, cells in enumerate(self.layout.cells):
            key = slot * cells + codes[k]
            self.count[k] += np.bincount(key, minlength=n * cells)
            self.total[k] += np.bincount(key, resid, n * cells)

    def vectors(self) -> np.ndarray:
        out = []
        for sums in (self.count, self.total):
            out += [sums[code].reshape(self.slots, -1, bins, stride).sum(axis=(1, 3)) for _, code, stride, bins in self.layout.place]
        return np.concatenate([*out, self.whole.T], axis=1)


def _exact_sums(layout: _Layout, slots: int, slot: np.ndarray, codes: np.ndarray, resid: np.ndarray) -> np.ndarray:
    """Rows, residuals and squares per slot and bin, each bin added up row by row as Spark ML adds."""
    out = []
    for w in (None, resid, resid * resid):
        for _, code, stride, bins in layout.place:
            out.append(np.bincount(slot * bins + codes[code] // stride % bins, w, slots * bins).reshape(slots, bins))
        out.append(np.bincount(slot, w, slots)[:, None])
    return np.concatenate(out, axis=1).astype(np.float64)


def _summed(layout: _Layout, tables: list[tuple[np.ndarray, np.ndarray]], slot_of: np.ndarray, large: int, slots: int):
    """Blocks to the sums of the nodes that have a slot; the first ``large`` slots by codes, the others row by row."""

    def run(part: int, blocks: Iterator[tuple[bytes, bytes, bytes]]):
        sums, few = _Sums(layout, large), []
        for codes, label, preds in map(_read, blocks):
            slot, resid = slot_of.take(_routed(codes, tables, len(label))), label if preds is None else label - preds
            if large:
                keep = np.flatnonzero((slot >= 0) & (slot < large))
                sums.add(slot.take(keep), [c.take(keep) for c in codes], resid.take(keep))
            if slots > large:
                keep = np.flatnonzero(slot >= large)
                few.append((slot.take(keep) - large, codes.take(keep, axis=1), resid.take(keep)))
        if sums.some:
            for slot, v in enumerate(sums.vectors()):
                yield slot, (part, v)
        if any(len(f[0]) for f in few):
            for slot, v in enumerate(_exact_sums(layout, slots - large, *[np.concatenate(v, axis=-1) for v in zip(*few)])):
                yield slot + large, (part, v)

    return run


def _added(sums: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """The sums of one slot over the tasks, in their order."""
    first, *others = [v for _, v in sorted(sums, key=lambda x: x[0])]
    total = first.copy()
    for v in others:
        total += v
    return total


def _moved(tables: list[tuple[np.ndarray, np.ndarray]], values: np.ndarray):
    """Blocks to blocks with the predictions moved by a tree."""

    def run(blocks: Iterator[tuple[bytes, bytes, bytes]]):
        for block in blocks:
            codes, label, preds = _read(block)
            step = values.take(_routed(codes, tables, len(label)))
            yield (block[0], (label - step).tobytes(), b"") if preds is None else (*block[:2], (preds + step).tobytes())

    return run


# ---------------------------------------------------------------- trees


class _Node(NamedTuple):
    """Rows, sum and (if known) impurity of the residuals, as the parent's split has them."""

    n: float
    s: float
    impurity: float | None = None


class _Growth:
    """Grows trees level by level."""

    def __init__(self, layout: _Layout, edges: list[np.ndarray], p: Mapping[str, Any], n_rows: int, gather: bool):
        self.layout, self.edges, self.p, self.n_rows, self.gather = layout, edges, p, n_rows, gather
        self.spans = layout.spans()

    def tree(self, blocks: RDD, old: RDD | None, scale: float) -> tuple[_Tree, list[tuple[np.ndarray, np.ndarray]]]:
        """One tree on the residuals times ``scale``, and the tables by which blocks go down it; the ``old`` blocks go when the root is summed."""
        p, layout, width, bins = self.p, self.layout, max(self.layout.cells, default=1), self.layout.n_bins
        nodes, sums = {0: _Node(self.n_rows, 0.0)}, {}
        values, levels, tables, gains = np.zeros(1), [], [], {}
        for level in range(p["maxDepth"] or 1):
            large = [i for i, node in nodes.items() if node.n > EXACT_ROWS]
            few = [i for i, node in nodes.items() if node.n <= EXACT_ROWS]
            # of two large children the one with more rows is what is left of the parent
            derived = [i for i in large if i ^ 1 in nodes and (nodes[i].n, i) > (nodes[i ^ 1].n, i ^ 1)]
            found = self.level_sums(blocks, tables, [i for i in large if i not in derived], few, 2 ** level)
            for i in derived:
                rest = sums[i // 2].copy()
                other = found[i ^ 1]
                rest[:2 * bins] -= other[:2 * bins] if i ^ 1 in large else other[[*range(bins), *range(bins + 1, 2 * bins + 1)]]
                # what is left of a bin without rows is rounding
                rest[bins:2 * bins][rest[:bins] == 0] = 0.0
                whole = other[-3:] if i ^ 1 in large else other[[bins, 2 * bins + 1, 3 * bins + 2]]
                rest[-3:] -= whole
                found[i] = rest
            if level == 0:
                if old is not None:
                    old.unpersist()
                whole = found[0][-3:] if large else found[0][[bins, 2 * bins + 1, 3 * bins + 2]]
                values = np.array([scale * whole[1] / whole[0]])
                if not p["maxDepth"]:
                    break
            feature, threshold = np.zeros(2 ** level, dtype=np.int64), np.full(2 ** level, np.inf)
            code, right = np.zeros(2 ** level, dtype=np.int64), np.zeros((2 ** level, width), dtype=np.uint8)
            below, children = np.repeat(values, 2), {}
            for i, node in sorted(nodes.items()):
                best = _best_split(found[i], self.spans, p, scale) if i in large else _exact_split(found[i], self.spans, bins, p, scale, node)
                if best is None:
                    continue
                f, bin_, gain, *sides = best
                feature[i], threshold[i] = f, self.edges[f][bin_]
                code[i], right[i] = layout.goes_right(f, bin_)
                gains[f] = gains.get(f, 0.0) + gain * scale ** 2 * (sides[0].n + sides[1].n)
                for child, side in zip((2 * i, 2 * i + 1), sides):
                    below[child] = scale * side.s / side.n
                    if side.impurity is None or abs(side.impurity) * scale ** 2 >= EPSILON:
                        children[child] = side
            if np.isinf(threshold).all():
                break
            levels.append((feature, threshold))
            tables.append((code, right))
            values, nodes, sums = below, children, found
            if not nodes:
                break
        return _Tree(levels, values, gains), tables

    def level_sums(self, blocks: RDD, tables: list, large: list[int], few: list[int], width: int) -> dict[int, np.ndarray]:
        """The sums of the nodes, of ``width`` on their level; those of many tasks are added up before they come to the driver."""
        nodes = [*large, *few]
        if not nodes:
            return {}
        slot_of = np.full(width, -1, dtype=np.int64)
        slot_of[nodes] = np.arange(len(nodes))
        sums = blocks.mapPartitionsWithIndex(_summed(self.layout, tables, slot_of, len(large), len(nodes)))
        if self.gather:
            return {nodes[slot]: v for slot, v in sums.groupByKey(min(len(nodes), GATHER)).mapValues(_added).collect()}
        by_slot: dict[int, list] = {}
        for slot, v in sums.collect():
            by_slot.setdefault(slot, []).append(v)
        return {nodes[slot]: _added(v) for slot, v in by_slot.items()}


def _best_split(sums: np.ndarray, spans: list[tuple[int, int, int]], p: Mapping[str, Any], scale: float):
    """(feature, bin, gain, left and right side) of a node with many rows, or None for a leaf."""
    n_all, s_all = sums[:-3].reshape(2, -1)
    n, s, square = sums[-3:]
    if abs((square - s * s / n) / n) * scale ** 2 < EPSILON:
        return None
    best, top = None, 0.0
    for f, start, end in spans:
        nl, sl = np.cumsum(n_all[start:end])[:-1], np.cumsum(s_all[start:end])[:-1]
        nr, sr = n - nl, s - sl
        can = (nl >= p["minInstancesPerNode"]) & (nr >= p["minInstancesPerNode"]) & (nl > 0) & (nr > 0)
        if not can.any():
            continue
        gain = np.where(can, nl * nr / (n * n) * (sl / np.where(can, nl, 1) - sr / np.where(can, nr, 1)) ** 2, -1.0)
        at = int(np.argmax(gain >= gain.max() * (1 - TIE)))
        if gain[at] > top * (1 + TIE):
            best, top = (f, at, float(gain[at]), _Node(nl[at], sl[at]), _Node(nr[at], sr[at])), float(gain[at])
    # a gain of rounding alone is none
    if best is None or top <= 1e-24 * square / n or top * scale ** 2 < p["minInfoGain"]:
        return None
    return best


def _variance(n, s, q):
    return (q - s * s / n) / n


def _exact_split(sums: np.ndarray, spans: list[tuple[int, int, int]], bins: int, p: Mapping[str, Any], scale: float, node: _Node):
    """As :func:`_best_split`, in Spark ML's arithmetic to the last bit: in a node of few rows features tie, and rounding decides."""
    per_bin, best, impurity = sums.reshape(3, bins + 1), None, node.impurity
    for f, start, end in spans:
        upto = np.cumsum(per_bin[:, start:end], axis=1)
        left, right = upto[:, :-1], upto[:, -1:] - upto[:, :-1]
        can = (left[0] > 0) & (right[0] > 0) & (left[0] >= p["minInstancesPerNode"]) & (right[0] >= p["minInstancesPerNode"])
        if impurity is None:
            impurity = _variance(*(left + right)[:, 0])
        if not can.any():
            continue
        (nl, sl, ql), (nr, sr, qr) = left[:, can], right[:, can]
        il, ir = _variance(nl, sl, ql), _variance(nr, sr, qr)
        gain = impurity - nl / (nl + nr) * il - nr / (nl + nr) * ir
        at = int(np.argmax(gain))
        if gain[at] > 0 and gain[at] * scale ** 2 >= p["minInfoGain"] and (best is None or gain[at] > best[2]):
            best = f, int(np.flatnonzero(can)[at]), float(gain[at]), _Node(nl[at], sl[at], il[at]), _Node(nr[at], sr[at], ir[at])
    return best
