import re

from hourgrid.llm import licenses
from hourgrid.llm.license_rules import ANCHORS, rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERNS = [(r, re.compile(r.pattern.replace("(?i)", "(?ia)", 1))) for r in rules()]


def brute(text):
    text = text or ""
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    places = [(i, label) for i in range(len(words)) for p, label in licenses.PHRASES if words[i:i + len(p.split())] == p.split()]
    found = [(m.start(), m.end(), r.priority, i, r.label, r.confidence) for i, (r, c) in enumerate(PATTERNS) if any(a in text.lower() for a in ANCHORS) for m in c.finditer(text)]

    def inside(d, e):
        same = d[:2] == e[:2]
        return e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or (e[2] == d[2] and (not same or e[3] < d[3])))

    kept = [d for d in found if not any(inside(d, e) for e in found)]
    score = max([d[5] for d in kept] + [licenses.BASE_CONFIDENCE if places else 0.0])
    return (len(words), [p[0] for p in places], sorted({p[1] for p in places} | {d[4] for d in kept}), sorted((d[0], d[1], d[4]) for d in kept), score)


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "MIT License mit license, MIT LICENSE gnu general public license",
    "GNU General Public License, version 3 (GPLv3)", None, "",
    "© 2020 x All rights reserved. SPDX-License-Identifier: Apache-2.0 http://www.apache.org/licenses/LICENSE-2.0",
    "é" * 10 + " licensed under the terms of the BSD-3-Clause, İ CC0 1.0 Universal",
    "Creative Commons Attribution-ShareAlike 4.0 International cc\tby-sa 4.0",
    "Permission is hereby granted, free of charge, to any person. The Unlicense. 0BSD " * 3,
    "apache\x7flicense cc-by 😀mit license mit license😀", "The license of the city. Copyright 2021 nobody", "Kelvin K licence" + "\u212a", "only GPLv3 and CC0 and gnu.org/copyleft/gpl here", "GPLv3 and CC0 and gnu.org/copyleft/gpl with copyright",
]


def test_rules_are_many_and_ordered():
    found = rules()
    assert len(found) > 300 and [r.priority for r in found] == sorted(r.priority for r in found)
    assert all(r.keyword == r.keyword.lower() for r in found)


def test_scan_matches_brute_force(table, texts):
    sample = TEXTS + [t for t in texts.values() if "icen" in t or "cc" in t][:40]
    df = table([(i, t, "s") for i, t in enumerate(sample)])
    for r in licenses.scan_licences(df).collect():
        got = (r.n_words, [p["at"] for p in r.places], r.labels, sorted((d["start"], d["end"], d["label"]) for d in r.detections), r.score)
        assert got == brute(sample[r.doc_id]), sample[r.doc_id]


def test_keywords_are_needed_by_their_patterns():
    """The prefilter loses nothing: no pattern matches a text without its keyword."""
    hints = [r.keyword for r in rules()] + ["licence", "license", "version 2.0", "Licensed under the terms of the", "SPDX-License-Identifier:"]
    names = ["GNU", "GPL 3.0", "Apache 2.0", "ASL 2", "MIT-0", "CC0", "CC BY 4.0", "BSD 3-clause", "OpenRAIL", "Unlicense", "0BSD", "WTFPL", "ELv2"]
    for text in hints + names + [f"{a} {b}" for a in hints[-5:] for b in names]:
        for rule, pattern in PATTERNS:
            if pattern.search(text):
                assert rule.keyword in text.lower(), (rule, text)


def test_query_columns(spark, sf, texts):
    rows = licenses.op5_signature_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, at, labels, _, score = brute(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (
            n, len(at), min(at, default=None), max(at, default=None), ",".join(labels), score)
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_edges(table):
    df = table([(None, "mit license", None), (1, "mit license " * 3000, "s"), (1, "mit license " * 3000, "s")])
    rows = licenses.scan_licences(df).collect()
    assert sorted(len(r.places) for r in rows) == [1, 3000, 3000]
    assert licenses.scan_licences(df.limit(0)).count() == 0
