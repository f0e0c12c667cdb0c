"""Connected components: of a link table by alternating star contractions, and inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import attach, hot_keys
from hourgrid.session import materialize


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` (a, b) and the smallest b of each a as m; the node that all others hang on may be one key, so hot nodes meet theirs by broadcast."""
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
    return attach(links, least.drop("_n"), ["a"], hot_keys(least, ["a"], "_n"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them (edges have a > b)."""
    known = _with_least(edges)
    moved = known.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(known.select("a", F.col("m").alias("b"))).distinct()


def with_component(linked: DataFrame, root: str, least: str, out: str) -> DataFrame:
    """A stored table of nodes with ``out``: the smallest ``least`` of all nodes of the same root; one root may hold most nodes."""
    smallest = materialize(linked.groupBy(root).agg(F.min(least).alias(out), F.count(F.lit(1)).alias("_n")), "smallest")
    return attach(linked, smallest.drop("_n"), [root], hot_keys(smallest, [root], "_n"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 20))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Every round is written to the shared folder. It ends when a round changes
    nothing: then each node points at its root. Self-links and repeated links
    are allowed; nodes without any link are not in the result.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_small_star(materialize(_large_star(edges), "links")), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Roots of the nodes ``x`` in a forest of parent positions."""
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = up


def unite(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the trees of x[k] and y[k] for all k; the smaller root stays."""
    while len(x):
        x, y = find(parent, x), find(parent, y)
        parent[:] = parent[parent]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
