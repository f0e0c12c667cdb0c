from collections import Counter, defaultdict

import pytest

from hourgrid.llm import mixing
from tests.llm.util import compare


def plain_targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Share by weight, hold what is above, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = float(sum(sizes.values())), set()
    while True:
        rest = total - sum(most * sizes[s] for s in held)
        free = sum(w[s] for s in names if s not in held)
        t = {s: most * sizes[s] if s in held else rest * w[s] / free for s in names}
        over = {s for s in names if s not in held and t[s] > most * sizes[s]}
        if not over:
            return t
        held |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 1000, "d": 2, "é": 50, None: 7}, {"a": 0, "b": 5}, {"x": 9}, {None: 0}, {"a": 1, "b": 1, "c": 0, "d": 500},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_query_matches_sql(spark):
    compare(spark, "/root/testdata/sf0.01", "op9_mix_by_threshold")


def _rows(n=900):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 3}") for i in range(n)]
    return rows + [(5000, None, None), (None, "a b c", "s1"), (5001, "", "s2"), (5002, "k " * 4000, "s0")] + [(7, "hot row", "s1")] * 600


def test_taken_is_near_the_target(table):
    df = table(_rows())
    rows = mixing.mix(df).collect()
    assert len(rows) == len(_rows())
    taken, size, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r.taken == r.size * r.copies and r.copies <= 3
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert {s: r for s, r in size.items()} == {r.source: r.source_size for r in rows}
    assert target == pytest.approx(plain_targets(size))
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6, s
    again = Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(df.repartition(7)).collect())
    assert again == Counter((r.doc_id, r.size, r.taken) for r in rows)


def test_mixed_documents_repeat_rows(table):
    df = table(_rows())
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    targets = plain_targets(Counter({s: sum(len((t or "").split()) for _, t, x in _rows() if x == s) for s in {x for *_, x in _rows()}}))
    for s in ("s0", "s2"):  # s1 holds equal rows, which draw together here
        assert abs(words[s] - targets[s]) <= 2000
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


def test_budgets_are_nested(spark):
    rows = spark.range(500).select(mixing.F.lit("=a").alias("sid"), mixing.F.lit(3).cast("long").alias("size"), mixing.draw(mixing.F.col("id"), mixing.F.lit(1)).alias("draw"))
    rows = mixing.materialize(rows, "t")
    last = -1
    for budget in (0.0, 10.0, 700.0, 1499.0):
        plan = spark.createDataFrame([("=a", 1500, budget)], "sid string, source_size long, target double")
        got = mixing.thresholds(rows, plan).first()
        n = rows.where(mixing.F.col("draw") < got.limit).count()
        assert got.full == 0 and abs(3 * n - budget) <= 1.5 and got.limit >= last
        last = got.limit
