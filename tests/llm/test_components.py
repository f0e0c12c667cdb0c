"""Components of link tables, also where one root holds all nodes."""

import random

import pytest

from hourgrid.llm import common, components


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


CASES = {
    "star": [(i, 0) for i in range(1, 300)], "hub at the top": [(999, i) for i in range(300)], "chain": [(i, i + 1) for i in range(200)],
    "random": [(random.Random(i).randrange(400), random.Random(i + 999).randrange(400)) for i in range(300)],
    "loops": [(1, 1), (2, 3), (3, 2), (2, 3)], "none": [],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("hot", [1, 1000])
def test_components_equal_a_plain_union(spark, monkeypatch, case, hot):
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    edges = CASES[case]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {k: v for k, v in plain([e for e in edges if e[0] != e[1]]).items()}
    assert len(got) == len(want) and {r.node: r.root for r in got} == want


def test_rows_of_one_root_are_not_exchanged(spark):
    """A component of all rows stays in the tasks that hold it: its root is joined by broadcast."""
    nodes = spark.range(0, 5000, 1, 8).selectExpr("id AS node", "0 AS root", "id + 7 AS least")
    out = components.with_component(nodes, "root", "least", "component")
    assert out.where("component = 7").count() == 5000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
