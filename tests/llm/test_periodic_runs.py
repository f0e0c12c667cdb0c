import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from hourgrid.llm import periodic_runs as pr


def brute(words, power=4, least=6):
    """Runs from the definition: for each period the maximal stretches of equal words, without those of a smaller period."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - i >= max(least, power * q) and (i, e + q) not in seen:
                seen.add((i, e + q))
                out.append((i, e + q - i, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(words):
    d = {}
    return np.array([d.setdefault(w, len(d)) for w in words], dtype=np.int64)


def test_runs_equal_the_definition():
    rng = random.Random(7)
    for _ in range(300):
        group = []
        for _ in range(rng.randint(0, 8)):
            words = [rng.randint(0, rng.choice((0, 1, 2, 9))) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < .7:
                a = rng.randrange(len(words))
                words = words[:a] + words[a:a + rng.randint(1, 9)] * rng.randint(1, 12) + words[:a]
            group.append(np.array(words, dtype=np.int64))
        got = pr.runs_of(group, 10)
        for words, runs in zip(group, got):
            assert [tuple(r) for r in runs.tolist()] == brute(words.tolist()), words.tolist()


def test_extensions_equal_a_plain_scan():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 5):
        text = np.concatenate([[0], rng.integers(0, letters, 400) + 3, [1], np.tile(rng.integers(0, letters, 7) + 3, 40), [2]])
        g = pr.Grammar(text, 3)
        i = rng.integers(1, 390, 500)
        j = i + rng.integers(1, 250, 500)
        for step in (1, -1):
            for a, b, n in zip(i, j, g.extend(i, j, step)):
                k = 0
                while text[a + step * k] == text[b + step * k]:
                    k += 1
                assert n == k
        assert len(g.levels[-1]) <= 6  # every document became one letter


def test_candidate_blocks_give_the_same(monkeypatch):
    words = numbers(("a b " * 50 + "c " * 70 + "d e f " * 30).split())
    want = pr.runs_of([words], 9)[0].tolist()
    monkeypatch.setattr(pr, "CANDIDATES", 3)
    assert pr.runs_of([words], 9)[0].tolist() == want == [list(r) for r in brute(words.tolist())]


def test_query_matches_brute_force(spark, sf, texts):
    rows = {r.doc_id: r for r in pr.op12_recompressed_runs(spark, sf).collect()}
    assert len(rows) == len(texts)
    changed = 0
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n > 0:
            changed += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = brute(words)
        r = rows[doc]
        assert r.n_runs == len(want)
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in want).encode()).hexdigest()
        gone = {i for s, size, q in want for i in range(s + q, s + size)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
    assert changed > 5


def test_ties_and_exact_exponents():
    assert pr.strongest(np.array([[9, 8, 2], [3, 12, 3], [1, 16, 4]])) == (1, 16, 4)
    assert pr.strongest(np.array([[0, 4_000_001, 1_000_000], [9, 8, 2]])) == (0, 4_000_001, 1_000_000)
    assert pr.strongest(np.zeros((0, 3), dtype=np.int64)) is None


@pytest.mark.parametrize("words", [["a"] * 300_000, ["a", "b"] * 150_000, [str(i % 1000) for i in range(300_000)], [str(i) for i in range(300_000)]])
def test_long_texts_in_bounded_time(words):
    start = time.time()
    runs = pr.runs_of([numbers(words)], len(set(words)))[0].tolist()
    assert time.time() - start < 60
    assert runs == ([] if len(set(words)) == 300_000 else [[0, 300_000, len(set(words))]])


def test_edges(table):
    long = "x y " * 200_000
    df = table([(1, None, "s"), (2, "", None), (None, "a a a a a a", "s"), (3, long, "s"), (3, long, "s"), (4, "  a b\x1cc", "s")])
    got = sorted(((r.doc_id, r.n_runs, r.collapsed) for r in pr.find_runs(df).collect()), key=str)
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "x y"), (3, 1, "x y"), (4, 0, "  a b\x1cc"), (None, 1, "a")]
    assert pr.find_runs(df.limit(0)).count() == 0
    assert pr.find_runs(df.withColumnRenamed("size", "a.b").selectExpr("*", "map('k', 1) AS m")).count() == 6
