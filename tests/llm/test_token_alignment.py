import hashlib
import random
from collections import Counter

import pytest

from hourgrid.llm import token_alignment as ta
from hourgrid.llm.bpe import vocabulary_path

A, B = vocabulary_path(), vocabulary_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    return ta.Tokenizers(A, B)


def brute(tokens, text):
    """(A ids, B ids, groups as text, links) of one text, token by token."""
    none = ([], [], "", [])
    if not text:
        return none
    a = tokens.a.encode(" " + text, add_special_tokens=False).ids
    b = tokens.b.encode(text)
    sides = []
    for ids, table in ((a, tokens.bytes_a), (b, tokens.bytes_b)):
        at, spans = 0, []
        for i in ids:
            spans.append((at, at + len(table[i])))
            at = spans[-1][1]
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return none
        sides.append(spans)
    links = []
    for i, (s, e) in enumerate(sides[0]):
        links += [(a[i], b[j]) for j, (t, f) in enumerate(sides[1]) if s < f and t < e] if len(a) < 400 else []
    if len(a) >= 400:
        j = 0
        for i, (s, e) in enumerate(sides[0]):
            while sides[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and sides[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
    ends = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
    groups, low = [], 0
    for end in ends:
        groups.append(",".join(str(a[i]) for i, (_, e) in enumerate(sides[0]) if low < e <= end) + "|"
                      + ",".join(str(b[i]) for i, (_, e) in enumerate(sides[1]) if low < e <= end)) if len(a) < 400 else None
        low = end
    if len(a) >= 400:
        groups, i, j = [], 0, 0
        for end in ends:
            x, y = i, j
            while i < len(a) and sides[0][i][1] <= end:
                i += 1
            while j < len(b) and sides[1][j][1] <= end:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
    return a, b, ";".join(groups), links


HARD = ["a", "  two  spaces ", "naïve café", "日本語のテキスト、漢字", "🙂🙂 emoji", "tab\there\nline\r\n", "<|endoftext|> x <s> </s> <0x41>", "a▁b", " lead", "x" * 300,
        "don't we'll I've", "1234567890 12 3.14", "\x00\x01", "ΑΒΓ где", "é", "　wide", "﻿bom", "http://a.b/c?d=e&f=%20", " ", "…—“”", "​ "]


def test_alignment_equals_brute_force(tokens):
    rng = random.Random(4)
    cases = HARD + [" ".join(rng.choice(HARD) for _ in range(rng.randint(1, 5))) for _ in range(300)]
    aligner = ta.Aligner(tokens)
    for text in cases:
        a, b, groups, links = brute(tokens, text)
        n_a, n_b, n_groups, n_links, digest, pairs, times, shown = aligner.align(text, groups=True)
        assert (n_a, n_b, n_links, shown) == (len(a), len(b), len(links), groups), text
        assert n_groups == (groups.count(";") + 1 if groups else 0)
        assert digest == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        want = Counter(x * tokens.size_b + y for x, y in links)
        assert dict(zip(pairs.tolist(), times.tolist())) == want


def test_parts_are_encoded_alike(tokens, texts):
    rng = random.Random(9)
    cases = [t for t in texts.values() if t][:60] + [" ".join(rng.choice(HARD) for _ in range(40)) for _ in range(60)]
    aligner, other = ta.Aligner(tokens), ta.Aligner(tokens)
    for text in cases:
        whole = aligner.align(text, groups=True)
        parts = other.align(text, chunk=20, groups=True)
        assert whole[:5] == parts[:5] and whole[7] == parts[7]
        assert whole[5].tolist() == parts[5].tolist() and whole[6].tolist() == parts[6].tolist()


def test_units_forgotten_are_learnt_again(tokens, texts, monkeypatch):
    cases = [t for t in texts.values() if t][:40]
    want = [ta.Aligner(tokens).align(t, groups=True) for t in cases]
    monkeypatch.setattr(ta, "MEMO", 50)
    aligner = ta.Aligner(tokens)
    for text, row in zip(cases, want):
        got = aligner.align(text, chunk=100, groups=True)
        assert got[:5] == row[:5] and got[5].tolist() == row[5].tolist() and got[6].tolist() == row[6].tolist() and got[7] == row[7]


def check(rows, texts, tokens):
    """Rows of the query against counts over ``texts`` (a list of (id, text))."""
    per = [brute(tokens, text) for _, text in texts]
    held = Counter(p for *_, links in per for p in set(links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    want = Counter()
    for (doc, _), (a, b, groups, links) in zip(texts, per):
        want[(doc, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(held[p] == most[p[0]] for p in links),
              sum(held[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")] += 1
    assert Counter(map(tuple, rows)) == want


def test_query_matches_brute_force(spark, sf, texts, tokens):
    check(ta.op13_end_slices(spark, sf).collect(), list(texts.items()), tokens)


@pytest.mark.parametrize("hot", [0, 3, 50])
def test_counts_beyond_the_hot_pairs(spark, table, tokens, hot):
    rows = [(i, random.Random(i).choice(HARD) + " and the " + "same words " * (i % 4)) for i in range(40)]
    got = ta.align_documents(table([(*r, "s") for r in rows]), A, B, hot=hot).collect()
    check(got, rows, tokens)


def test_edges(table, tokens):
    long = "wort und word " * 60_000
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same text"), (3, "same text"), (4, "a▁b"), (5, long)]
    df = table([(*r, "s") for r in rows])
    got = ta.align_documents(df, A, B).collect()
    by = {(r.doc_id, r.n_a, r.n_groups > 0, r.groups_sha256 == "") for r in got}
    assert {(1, 0, False, True), (2, 0, False, True), (4, 0, False, True)} <= by and len(got) == 7
    check(got, rows, tokens)
    assert ta.align_documents(df.limit(0), A, B).count() == 0
    assert ta.align_documents(df.withColumnRenamed("size", "a.b").selectExpr("*", "map('k', 1) AS m"), A, B).count() == 7
