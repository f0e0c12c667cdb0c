"""Extra columns of any name and type, ids of any text, and joins beyond what is broadcast."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourgrid.llm import common, mixing, url_filter, warc

GOOD = " ".join(f"{a}{b}" for a in ("river", "stone", "window", "garden", "market", "paper", "silver", "morning") for b in ("s", "side", "ing", "ed", "ly", "er", "less", "like", "en", "ful"))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name_and_type(spark, sf, name, stage):
    rows = [(i, GOOD + f" number {i} {'x' * (i % 7)}" if i % 5 else None, "en", f"s{i % 3}", 5, {"k": i}, f"v{i}", [i], "t") for i in range(60)]
    rows += [rows[7], rows[7]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a map` map<string,int>, "
                                       "`extra.col` string, `tick``s` array<int>, _hash string")
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    want = {r[0]: (r[5], r[6]) for r in rows}
    got = out.collect()
    assert all(want[r.doc_id] == (r["a map"], r["extra.col"]) for r in got)
    if name in ("pii", "quality_rules"):
        assert len(got) == (62 if name == "pii" else sum(r[1] is not None for r in rows))
    tokens = corpus_pipeline.bpe(spark, docs, sf)
    assert tokens.count() == 62


def test_attach_beyond_the_hot_keys(spark):
    big = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(7)] + [("c", 1), ("none", 2)], "k string, `x.y` int")
    small = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    counted = big.groupBy("k").count()
    want = Counter((r[0], r[1], {"a": 1, "b": 2, "c": 3}.get(r[0])) for r in big.collect())
    for most in (1, 2, 1000):
        hot = common.hot_keys(counted, ["k"], "count", most)
        assert hot.complete == (most == 1000) and [r.k for r in hot.keys.collect()][:1] == ["a"]
        out = common.attach(big, small, ["k"], hot)
        assert out.columns == ["k", "x.y", "v"] and Counter(map(tuple, out.collect())) == want


def test_marks_have_no_misses_and_few_false_alarms(spark):
    rows = spark.range(20000).select(F.col("id").alias("k.1"))
    keys = spark.range(0, 20000, 10).select("id")
    out = common.mark_possible(rows, F.xxhash64(F.col("`k.1`")), keys, F.xxhash64("id"), "maybe").collect()
    assert len(out) == 20000 and all(r.maybe for r in out if r[0] % 10 == 0)
    assert sum(r.maybe for r in out) < 2020
    empty = common.mark_possible(rows, F.xxhash64(F.col("`k.1`")), keys.limit(0), F.xxhash64("id"), "maybe")
    assert empty.where("maybe").count() == 0 and empty.count() == 20000


@pytest.fixture
def few_hot(monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 2)


def test_operators_beyond_the_hot_keys(spark, sf, few_hot, monkeypatch):
    """op7, op9 and op10 give the same rows when most keys are joined by exchange."""
    got = {}
    for most in (2, 100000):
        monkeypatch.setattr(common, "HOT_KEYS", most)
        got[most] = [Counter(map(tuple, q(spark, sf).collect())) for q in (url_filter.op7_url_reputation, mixing.op9_mix_by_threshold, warc.op10_zip_archives)]
    assert got[2] == got[100000]


def test_only_repeated_payloads_are_exchanged(spark, few_hot, tmp_path):
    rows = [(i, f"http://x/{i}", f"payload {i if i % 4 else i % 3} {'z' * 50}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_packages(pages, str(tmp_path / "p"))
    back = {int(r.page_id): r for r in warc.read_packages(spark, str(tmp_path / "p")).collect()}
    smallest = {}
    for i, _, body in rows:
        smallest.setdefault(body, i)
    assert len(back) == 400
    for i, _, body in rows:
        first = smallest[body]
        assert (back[i].record_type, back[i].refers_to) == (("response", None) if first == i else ("revisit", str(first)))
        assert back[i].payload == (body.encode() if first == i else None)


def test_ids_of_any_text_come_back(spark, tmp_path):
    ids = ["", None, "a b", "line\nbreak\r\n", "x:y>z", "%41", "é ", "response", "urn:nopage", "0"]
    rows = [(x, "http://h/", f"body {n % 7}") for n, x in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string").selectExpr("*", "'q' AS `digest.x`", "map('k', 1) AS first")
    warc.write_packages(pages, str(tmp_path / "p"))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in warc.read_packages(spark, str(tmp_path / "p")).collect())
    import base64

    assert got == Counter((x, len(b), base64.b32encode(hashlib.sha1(b.encode()).digest()).decode()) for x, _, b in rows)
