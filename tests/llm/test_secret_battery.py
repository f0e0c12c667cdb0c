import base64
import hashlib
import random
import re
import string
import time

import numpy as np

from hourgrid.llm import secret_battery as sb


def brute(text):
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
                         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


PARTS = ["password", "PassWd", "secret", "token", "api_key", "apiKey", "api__key", "=", ":", " ", "'", '"', "abc", "abcdef", "AKIA", "AKIA" + "Z9" * 8,
         "ABCDEFGH", "0123456789ab", "deadbeef", "ſecret", "toKen", "é", "\n", "\t", ".", "-", "+/_", "==", "x" * 15, "f" * 24]


def test_base_spans_match_plain_patterns():
    rng, finder = random.Random(5), sb.Finder()
    for _ in range(20000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        assert finder.find(text)[0] == brute(text), text


def test_query_matches_brute_force(spark, sf, texts):
    rows = sb.op11_secret_battery(spark, sf).collect()
    assert len(rows) == len(texts)
    names = sb.BASE
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[1] == k for w in want) for k in range(3))
        assert {f"{names[k]}:{a}:{b}" for a, k, b in want} <= set(filter(None, [*r.spans.split(","), *([] if want else [""])]))


def test_battery_keeps_random_strings_and_rejects_structure():
    rng = np.random.default_rng(3)
    random_rows = sb.battery(rng.integers(0, 62, (4000, 40)), 62)
    assert (random_rows < sb.LIMIT).mean() > 0.97
    ramp = np.arange(40)[None, :]
    assert sb.battery(ramp, 62)[0] > sb.LIMIT and sb.battery(np.zeros((1, 40), dtype=int), 62)[0] == sb.TOP
    assert sb.battery(np.tile([0, 61], 20)[None, :], 62)[0] > sb.LIMIT


def test_false_discoveries_are_controlled_by_length(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("etaoinshrdlu" if rng.random() < .8 else string.ascii_lowercase) for _ in range(rng.randint(3, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(60)]
    keys = ["".join(rng.choice(sb.ENCODINGS["b62"]) for _ in range(40)) for _ in range(30)]
    long_words = ["".join(rng.choice(words) for _ in range(8))[:40] for _ in range(200)]
    rows = [(i, text, "s") for i, text in enumerate(prose)]
    rows += [(1000 + i, f"see {key} here", "s") for i, key in enumerate(keys)]
    rows += [(2000 + i, f"see {word} here", "s") for i, word in enumerate(long_words)]
    got = {r.doc_id: r.spans for r in sb.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    hits = [d for d, spans in got.items() if any(s["kind"] >= 3 for s in spans)]
    true = [d for d in hits if 1000 <= d < 2000]
    assert len(true) >= 27 and len(hits) - len(true) <= 0.1 * len(hits)
    start, kind, end = next(s for s in got[true[0]])
    assert (start, end) == (4, 44) and sb.KINDS[kind] == "b62"


def test_encodings_and_base_overlap():
    assert [sb.NAMES[sb.encoding_of(s)] for s in ("0af9" * 5, "GEZDGNB2" * 2, "abcd9z" * 3, "aB3" * 6, "a+/B" * 4, "a-_B" * 4)] == ["hex16", "b32", "b36", "b62", "b64", "b64url"]
    assert sb.encoding_of("1234567890" * 2) is None and sb.encoding_of("a+_b" * 4) is None
    token = base64.b64encode(bytes(range(100, 140))).decode()
    base, found = sb.Finder().find(f"token = {token}")
    assert [b[1] for b in base] == [0] and found == []


def test_time_is_linear_in_hard_texts():
    for text in ("a" * 300000, "token" * 60000, "token" + " " * 300000 + ":", "AKIA" * 70000, "0123456789abcdef" * 20000, "token=" * 50000):
        start = time.time()
        sb.Finder().find(text)
        assert time.time() - start < 5, text[:6]


def test_written_text_counts_every_letter_once():
    w = sb.Written()
    text = "ab c1. " * 20000
    for part in (text[:50], text[50:]):
        w.add(part)
    used = sum(sb.CLASSES[c] * n for _, c, _, n in w.finish())
    assert 80000 - max(sb.CLASSES) < used <= 80000


def test_edges(table):
    key = "".join(random.Random(1).choice(sb.ENCODINGS["b62"]) for _ in range(60))
    long = "wort " * 60_000 + " token=abcdefgh " + key
    df = table([(1, None, "s"), (2, "", None), (None, "token: abcdef", "s"), (3, long, "s"), (3, long, "s")])
    got = sorted(((r.doc_id, tuple(s["kind"] for s in r.spans)[:1]) for r in sb.find_secrets(df).collect()), key=str)
    assert got == [(1, ()), (2, ()), (3, (0,)), (3, (0,)), (None, (0,))]
    assert sb.find_secrets(df.limit(0)).count() == 0
    odd = df.withColumnRenamed("size", "a.b").selectExpr("*", "map('k', 1) AS m")
    assert sb.find_secrets(odd).count() == 5


def test_counts_are_by_kind_wherever_a_span_stands(spark, tmp_path):
    access, hexa = "AKIA" + "Z9" * 8, "0af9" * 6
    texts = {1: f"password=abcdef {access} {hexa}", 2: f"{hexa} x {hexa}", 3: f"{access} token: abcdef secret=abcdef", 4: "api_key = abcdef", 5: "none", 6: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in sb.op11_secret_battery(spark, str(tmp_path)).collect()}
    for doc, text in texts.items():
        want = brute(text or "")
        assert (got[doc].n_assign, got[doc].n_access, got[doc].n_hex) == tuple(sum(w[1] == k for w in want) for k in range(3)), doc
        assert got[doc].base_sha256 == hashlib.sha256(",".join(f"{sb.BASE[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
