from collections import Counter

from hourgrid.llm import mixing
from tests.llm.test_mixing import plain_targets


def _words(text):
    return len((text or "").split())


def _rows():
    rows = [(i, "w " * (1 + i % 40), f"s{i % 3}") for i in range(600)] + [(7, "hot row", "s1")] * 600
    rows += [(None, f"n{i} " * (1 + i % 30), "s0") for i in range(400)] + [(None, "same null row", "s1")] * 300
    return rows + [(8, f"m{i} " * (1 + i % 9), "s2") for i in range(300)] + [(9, None, None), (9, None, None)]


def test_shared_ids_are_not_one_block(table, monkeypatch):
    monkeypatch.setattr(mixing, "COPY_BLOCK", 100)
    rows, sizes, largest = _rows(), Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += _words(text)
        largest[source] = max(largest[source], _words(text))
    want, df = plain_targets(sizes), table(rows)
    words, taken = Counter(), Counter()
    out = mixing.mixed_documents(df).collect()
    for r in out:
        words[r.source] += _words(r.text)
    for r in mixing.mix(df).collect():
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(words[s] - want[s]) <= largest[s] / 2 + 1e-6, (s, words[s], want[s])
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, (s, taken[s], want[s])
    again = mixing.mixed_documents(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_copies_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPY_BLOCK", 10)
    groups = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 35)], "k string, _n long")
    got = Counter((r.k, r._copy) for r in mixing.each_copy(groups, ["k"]).collect())
    assert got == Counter((k, i + 1) for k, n in (("a", 1), ("b", 10), ("c", 11), ("d", 35)) for i in range(n))
