from collections import Counter

import numpy as np

from hourgrid.llm import cover_tree as ct
from hourgrid.llm.common import read
from tests.llm.util import compare


def test_trees_count_every_link():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, d = int(rng.integers(2, 400)), int(rng.integers(2, 12))
        base = rng.normal(size=(max(1, n // int(rng.integers(1, 20))), d))
        x = ct.unit(base[rng.integers(0, len(base), n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.1, 0.3]))
        w = rng.integers(1, 4, n)
        near = x @ x.T >= 0.93
        np.fill_diagonal(near, False)
        tree, links = ct.build(x), ct.Links(x, w, None, None, 0.93)
        links.walk(tree, tree)
        assert (links.count == near @ w).all()
        k = n // 2
        links = ct.Links(x[:k], w[:k], x[k:], w[k:], 0.93)
        links.walk(ct.build(x[:k]), ct.build(x[k:]))
        assert (links.count == np.concatenate([near[:k, k:] @ w[k:], near[:k, k:].T @ w[:k]])).all()


def test_levels_halve_and_cover():
    x = ct.unit(np.random.default_rng(2).normal(size=(500, 6)))
    todo = [(ct.build(x), 2.0)]
    while todo:
        node, r = todo.pop()
        far = np.sqrt(np.maximum(0, 2 - 2 * x[node.members] @ x[node.centre]))
        assert far.max() <= node.radius + 1e-7 and node.radius <= r + 1e-9 and node.members[0] == node.centre
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            todo += [(c, r / 2) for c in node.children]


def test_query_matches_sql(spark):
    compare(spark, "/root/testdata/sf0.01", "op8_cover_tree")


def _brute(rows):
    ok = [i for i, r in enumerate(rows) if r.label is not None and r.embedding and all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    near = np.eye(len(rows), dtype=bool)
    groups: dict = {}
    for i in ok:
        groups.setdefault((rows[i].label, len(rows[i].embedding)), []).append(i)
    for at in groups.values():
        x = ct.unit(np.array([rows[i].embedding for i in at], dtype=float))
        near[np.ix_(at, at)] |= x @ x.T >= 0.93
    label = np.array([2**62 if r.vec_id is None else r.vec_id for r in rows], dtype=np.int64)
    while True:
        nxt = np.array([label[row].min() for row in near])
        if (nxt == label).all():
            break
        label = nxt
    out = [(r.vec_id, int(near[i].sum()) - 1, None if label[i] == 2**62 else int(label[i])) for i, r in enumerate(rows)]
    return Counter((*x, x[0] == x[2]) for x in out)


def test_edges_and_blocks(spark, sf):
    odd = [(9001, None, 1), (9002, [0.0] * 64, 1), (9003, [float("nan")] * 64, 1), (9004, [1.0] * 64, None), (9005, [1.0] * 64, 3), (9006, [2.0] * 64, 3),
           (9005, [1.0] * 64, 3), (None, [2.0] * 64, 3), (9007, [], 3), (9008, [1.0, None], 3), (9009, [float("inf")] * 64, 3), (None, [1.0, 2.0], 8)]
    df = read(spark, sf, "embeddings").limit(200).unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int"))
    df = df.selectExpr("*", "'x' AS vec", "'u' AS uid")
    want = _brute(df.collect())
    for block in (2048, 8):
        got = ct.near_vectors(df, block=block)
        assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == want
    assert ct.near_vectors(df.limit(0)).count() == 0


def test_large_group_of_copies(spark):
    df = spark.range(3000).selectExpr("id AS vec_id", "array(1.0f, CAST(id % 2 AS FLOAT) / 100) AS embedding", "1 AS label")
    rows = ct.near_vectors(df, block=64).collect()
    assert {(r.n_links, r.component_id) for r in rows} == {(2999, 0)} and sum(r.kept for r in rows) == 1
