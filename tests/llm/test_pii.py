import hashlib
import random
import re
import time

from hourgrid.llm import pii


def brute(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits, total = re.sub("[^0-9]", "", m[0]), 0
        for i, c in enumerate(reversed(digits)):
            total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


PARTS = ["a", "b@", "@", "x.y", "é", ".", "..", "1", "12", "255", "256", "+", "+1", " ", "-", "4111111111111111", "(", ")", "\n", "%", "_",
         "a.b@c.d", "1.2.3.4", "378282246310005", "٣", "0001"]


def test_base_spans_match_plain_patterns():
    rng, finder = random.Random(2), pii.Finder()
    for _ in range(20000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert sorted((a, pii.BASE.index(k), b, k) for a, b, k in finder.base(text)) == brute(text), text


def test_method_spans_need_checksum_and_context():
    finder = pii.Finder()
    kinds = [k for k, *_ in finder.spans("Bank account GB82 WEST 1234 5698 7654 32, ssn 123-45-6789, card 4222222222222")]
    assert kinds == ["iban", "ssn", "card13"]
    assert finder.spans("GB83 WEST 1234 5698 7654 32 and 123-45-6789 and 4222222222222") == []
    assert finder.spans("ssn 000-45-6789, 987-65-4321") == []


def test_base_spans_stay_when_the_method_overlaps():
    spans = pii.Finder().spans("card 4111 1111 1111 1111 account")
    assert [s[0] for s in spans] == ["card"]


def test_time_is_linear_in_hard_texts():
    finder = pii.Finder()
    for text in ("a" * 200000, "1" * 200000, "1." * 100000, "@" * 200000, "+1" * 100000, "a@" * 100000, "1-" * 100000, "+1" + " " * 200000):
        start = time.time()
        finder.spans(text)
        assert time.time() - start < 5, text[:4]


def test_query_matches_brute_force(spark, sf, texts):
    rows = pii.op1_pii_checksums(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[3] == k for w in want) for k in pii.BASE)
        assert {f"{k}:{a}:{b}" for a, _, b, k in want} <= set(r.spans.split(","))


def test_edges(table):
    long = "x" * 300_000 + " a@b.co"
    df = table([(1, None, "s"), (2, "", None), (None, "a@b.co", "s"), (3, long, "s"), (3, long, "s")])
    got = {(r.doc_id, len(r.spans)) for r in pii.find_pii(df).collect()}
    assert got == {(1, 0), (2, 0), (None, 1), (3, 1)}
    clean = pii.redact(df)
    assert clean.columns == df.columns and clean.schema["text"].dataType.simpleString() == "string"
    texts = {(r.doc_id, r.text if r.text is None else r.text[-8:]) for r in clean.collect()}
    assert texts == {(1, None), (2, ""), (None, "<EMAIL>"), (3, " <EMAIL>")}
    assert pii.find_pii(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).count() == 0
