import hashlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from hourgrid.llm import bpe, mixing, pii, quality
from hourgrid.llm.common import read
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality import brute as brute_stats
from tests.llm.test_simhash import brute_groups, brute_print


def _draw(doc_id):
    return int(hashlib.md5(f"mix/{doc_id}/1".encode()).hexdigest()[:13], 16)


def test_stages():
    assert [f for _, f in cp.STAGES] == [cp.quality_rules, cp.simhash_near_dedup, cp.pii, cp.mixing, cp.bpe]
    assert cp.ORACLE_SQL is None


def test_run_matches_brute_force(spark, sf):
    docs = [r.asDict() for r in read(spark, sf, "documents").collect()]
    rules = quality.fit(read(spark, sf, "documents"), read(spark, sf, "labels"))
    verdict = {r.doc_id: r.kept for r in quality.judge(read(spark, sf, "documents"), rules).collect()}
    assert all(not verdict[d["doc_id"]] for d in docs if brute_stats(d["text"])[-1])
    docs = [d for d in docs if verdict[d["doc_id"]]]
    groups = brute_groups([d["doc_id"] for d in docs], np.array([brute_print(d["text"]) for d in docs], dtype=np.uint64))
    docs = [d for d, g in zip(docs, groups) if d["doc_id"] == g]
    finder = pii.Finder()
    for d in docs:
        d["text"] = pii.redacted(d["text"], finder.spans(d["text"]))
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += len(d["text"].split())
    want = Counter()
    for source, target in plain_targets(sizes).items():
        own = sorted((d for d in docs if d["source"] == source), key=lambda d: _draw(d["doc_id"]))
        full = int(target // sizes[source]) if sizes[source] else 0
        left, open_ = target - full * sizes[source], True
        for d in own:
            size = len(d["text"].split())
            more = open_ and (size <= left or 2 * left >= size)
            open_ = open_ and size <= left
            left -= size
            want[d["doc_id"]] += full + more
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    texts = {d["doc_id"]: d["text"] for d in docs}
    rows = cp.run(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == +want
    for r in rows:
        assert list(r.ids) == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns_and_clash_with_nothing(spark, sf):
    docs = read(spark, sf, "documents").limit(60).selectExpr("*", "1 AS size", "'x' AS fp", "'y' AS _stats", "'z' AS row", "2 AS sid")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert stage(spark, docs.limit(0), sf).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "x " * 80, "en", None, 5), (1, "x " * 80, "en", None, 5)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        stage(spark, odd, sf).collect()


def test_draws_agree(spark):
    got = [r.d for r in spark.range(20).select(mixing.draw(mixing.F.col("id"), mixing.F.lit(1)).alias("d")).collect()]
    assert got == [_draw(i) for i in range(20)]
