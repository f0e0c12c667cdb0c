import random
import re
from collections import Counter

import numpy as np

from hourgrid.llm import quality
from hourgrid.llm.common import read


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_statistics_match_brute_force(table):
    rng = random.Random(3)
    bits = ["a ", "b ", "c\n", "ab ", "é#  ", "\t", "|", " x", " ", "\n", "😀 "]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 120))), "s") for i in range(250)]
    rows += [(900, None, "s"), (None, "a b c " * 20, None), (901, "", "s"), (902, " \n \n", "s"), (903, "w x y z " * 4000, "s"), (903, "w x y z " * 4000, "s")]
    df = table(rows)
    texts = {r[0]: r[1] for r in rows}
    got = quality.judge(df, []).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (*[r[c] for c in quality.BASE], r.base_failed) == brute(texts[r.doc_id]), texts[r.doc_id]
        assert r.kept == (not r.base_failed)
    kept = quality.keep_good(df, [])
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    assert quality.judge(df.limit(0), []).count() == 0


def test_list_is_learned_and_held_out():
    rng = np.random.default_rng(5)
    n = 3000
    x = rng.uniform(0, 1, size=(n, len(quality.FEATURES)))
    junk = (x[:, 0] > 0.8) | ((x[:, 4] > 0.7) & (x[:, 5] > 0.7))
    rules = quality.learn_rules(x[:2000], junk[:2000])
    hit = np.zeros(1000, dtype=bool)
    for rule in rules:
        hit |= quality._covers(rule, x[2000:])
    assert 1 <= len(rules) <= quality.MAX_RULES and all(len(r) <= quality.MAX_TERMS for r in rules)
    assert (hit & ~junk[2000:]).sum() <= 0.02 * (~junk[2000:]).sum() and (hit & junk[2000:]).sum() >= 0.9 * junk[2000:].sum()
    # noise teaches nothing
    assert quality.learn_rules(x[:600], rng.uniform(size=600) < 0.1) == []
    assert quality.learn_rules(x[:0], junk[:0]) == []


def test_rules_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    rules = quality.fit(docs, labels)
    assert rules
    judged = quality.judge(docs, rules).join(labels, "doc_id").where("NOT base_failed").collect()
    clean = [r.kept for r in judged if r.quality == 1]
    junk = [r.kept for r in judged if r.quality == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) <= 0.2 * len(junk)


def test_fit_without_labels(spark, table):
    labels = spark.createDataFrame([(None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    df = table([(1, "a b c " * 30, "s"), (None, "x", "s")])
    assert quality.fit(df, labels) == [] and quality.fit(df, labels.limit(0)) == []


def test_order_of_rules(table):
    df = table([(1, " ".join(f"w{i}" for i in range(60)) + " ###", "s")])
    row = quality.judge(df, [(("symbols", ">", 0.9),), (("symbols", ">", 0.01), ("digits", ">", 0.0))]).first()
    assert row.rule == 2 and not row.kept and not row.base_failed
