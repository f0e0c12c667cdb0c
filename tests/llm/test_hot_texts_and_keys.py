"""Texts of very many notices, and very many rows without an id."""

import random
import time
from collections import Counter

from pyspark.sql import functions as F

from hourgrid.llm import licenses, sharding
from tests.llm.test_licenses import brute


def test_many_notices_equal_brute_force(table, monkeypatch):
    monkeypatch.setattr(licenses, "STEP", 4)
    rng = random.Random(3)
    parts = ["Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3 (GPLv3)", "MIT License", "Apache License, Version 2.0", "copyright 2020 x All rights reserved.",
             "SPDX-License-Identifier: MIT", "http://www.apache.org/licenses/LICENSE-2.0", "plain words", "é😀"]
    sample = ["\n".join(rng.choice(parts) for _ in range(n)) for n in (1, 3, 4, 5, 8, 9, 30, 60) for _ in range(3)]
    for r in licenses.scan_licences(table([(i, t, "s") for i, t in enumerate(sample)])).collect():
        got = (r.n_words, [p["at"] for p in r.places], r.labels, sorted((d["start"], d["end"], d["label"]) for d in r.detections), r.score)
        assert got == brute(sample[r.doc_id]), sample[r.doc_id]


def test_a_text_of_fifty_thousand_notices(table):
    one = "This file is under the MIT License. "
    few, many = one * 10, one * 50_000
    licenses.scan_licences(table([(0, few, "s")])).collect()  # plans and compiles
    start = time.time()
    row = licenses.scan_licences(table([(1, many, "s")])).first()
    assert time.time() - start < 60
    first = [(d["start"], d["end"], d["label"]) for d in licenses.scan_licences(table([(0, few, "s")])).first().detections]
    per = len(first) // 10
    assert len(row.detections) == per * 50_000 and row.places[-1]["at"] - row.places[0]["at"] == 7 * 49_999
    assert [(d["start"], d["end"], d["label"]) for d in row.detections[-per:]] == [(a + 49_999 * len(one), b + 49_999 * len(one), x) for a, b, x in first[:per]]


def test_rows_without_an_id_fall_into_many_blocks(spark):
    docs = spark.range(6000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    rows = sharding.assign_shards(docs, rows_per_block=20)
    got = rows.collect()
    hot = Counter(r.shard for r in got if r.doc_id is None)
    assert len(hot) == 1 and sum(hot.values()) == 2000
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # neighbours in the numbering of the hot shard are not neighbours by content: many blocks were ranked apart
    inside = sorted((r.slot, r.size, r.text_crc32) for r in got if r.doc_id is None)
    drops = sum(a[1:] > b[1:] for a, b in zip(inside, inside[1:]))
    assert drops >= 5


def test_copies_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPY_BLOCK", 7)
    docs = spark.range(100).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.assign_shards(docs).collect()
    assert sorted(r.slot for r in got) == list(range(100)) and len({r.shard for r in got}) == 1
