import random
import re

import numpy as np
import xxhash

from hourgrid.llm import simhash as sh
from hourgrid.llm.components import connected_components


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints, bits=2):
    fps = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = np.array([2**62 if i is None else i for i in ids], dtype=np.int64)
    while True:
        nxt = np.array([label[row].min() for row in near])
        if (nxt == label).all():
            return [None if x == 2**62 else int(x) for x in label]
        label = nxt


def test_fingerprint():
    rng = random.Random(1)
    for t in ["", None, "a", "A b", "a b C", "É b  c\td e f g h", "x " * 200, " \n"]:
        assert sh.fingerprint(t) == brute_print(t), t
    for _ in range(300):
        t = " ".join(rng.choice("abcdefÄ") for _ in range(rng.randint(1, 40)))
        assert sh.fingerprint(t) == brute_print(t)


def _keys():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(200)]
    keys = set(base)
    for b in base[:100]:
        for _ in range(15):
            x = b
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            keys.add(x)
    return np.array(sorted(keys | {0, 1, 2**64 - 1}), dtype=np.uint64)


def test_trie_finds_every_link_once(monkeypatch):
    monkeypatch.setattr(sh, "FRONTIER", 300)
    keys = _keys()
    near = np.bitwise_count(keys[:, None] ^ keys[None, :])
    for bits in (0, 1, 2, 3):
        got = [p for i, j in sh.trie_links(keys, None, bits) for p in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for i, j in zip(*np.nonzero(near <= bits)) if i < j}
    a, b = keys[::2], keys[1::2]
    got = {p for i, j in sh.trie_links(a, b) for p in zip(i.tolist(), j.tolist())}
    assert got == {(i, j) for i, j in zip(*np.nonzero(near[::2, 1::2] <= 2))}


def test_forest_joins_leaves_of_any_depth(spark):
    keys = _keys()
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "fp long")
    want = brute_groups(keys.view(np.int64).tolist(), keys)
    for leaf in (10**6, 40, 3):
        roots = {r.node: r.root for r in connected_components(sh.trie_forest(df, len(keys), 2, leaf)).collect()}
        assert [roots.get(k, k) for k in keys.view(np.int64).tolist()] == want


def test_query_matches_brute_force(spark, sf, texts):
    rows = sh.op2_simhash_trie(spark, sf).collect()
    ids = [r.doc_id for r in rows]
    prints = [brute_print(texts[i]) for i in ids]
    assert [int(r.fingerprint, 16) for r in rows] == prints and all(len(r.fingerprint) == 16 for r in rows)
    assert [r.component_id for r in rows] == brute_groups(ids, prints)


def test_edges(table):
    rows = [(5, None, "s"), (3, "", "s"), (9, " \n", "s"), (4, "a b c d", "s"), (4, "a b c d", "s"), (None, "a b c d", "s"), (None, "only here", "s"),
            (7, "B " * 5000, "s"), (8, "b " * 5001, "s")]
    df = table(rows)
    got = sorted(((r.doc_id, r.component_id) for r in sh.simhash_components(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 4), (4, 4), (None, 4), (None, None), (7, 7), (8, 7)], key=str)
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text[:9]) for r in kept.collect()), key=str) == sorted([(3, ""), (4, "a b c d"), (None, "only here"), (7, "B B B B B")], key=str)
    assert sh.simhash_components(df.limit(0)).count() == 0 and sh.keep_one(df.limit(0)).count() == 0


def test_large_groups_of_copies(table):
    same = [(i, "one two three four five six", "s") for i in range(100, 700)]
    got = {r.component_id for r in sh.simhash_components(table(same)).collect()}
    assert got == {100}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 200 for i in [*range(200, 260), 1000]}}
