import hashlib
import random

import pytest
from tokenizers import Tokenizer

from hourgrid.llm import bpe


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def tables():
    return bpe.Bpe(bpe.vocabulary_path())


def ids_of(encoder, text):
    return [i for segments in encoder.encode([text]) for part in segments for i in part]


PARTS = ["a", "B", "é", " ", "  ", "\n", "\n\n", "\t", "1", "23", "'s", "'ll", "!", "?", "\r\n", "\x1c", " ", "　", "<|endoftext|>", "<|endof",
         "hello", "ing", "日本", "😀", "\x00", "\x85", "'", "S"]


@pytest.mark.parametrize("with_lexicon", [False, True])
def test_encodes_like_the_library(tokenizer, tables, with_lexicon):
    words = [w.encode() for w in ("a", " hello", "ing", "hello", " 23", "!?", "日本")]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(dict(zip(words, tables.merge(words))))) if with_lexicon else None
    encoder, rng = bpe.Encoder(tables, lexicon), random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids_of(encoder, text) == want, text
        assert b"".join(tables.bytes_of[i] for i in want).decode("utf-8", "replace") == tokenizer.decode(want, skip_special_tokens=False)


def test_every_character(tokenizer, tables):
    encoder = bpe.Encoder(tables, None)
    chars = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = [f"a{chr(c)}a {chr(c)}{chr(c)} 1{chr(c)}" for c in chars]
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(encoder, text) == want.ids, repr(text)


def test_long_runs_and_segments(tokenizer, tables, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    monkeypatch.setattr(bpe, "MEMO", 40)
    encoder = bpe.Encoder(tables, None)
    for text in ("a" * 5000, " " * 3000 + "x", "ab" * 4000, "ing" * 2000 + " " + "!?" * 3000, "é" * 3000, "word other\nline  two " * 300):
        assert ids_of(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_automaton_is_minimal_and_exact():
    rng = random.Random(4)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(900)})
    data = bpe.compile_lexicon({w: (i, i + 1) for i, w in enumerate(words)})
    lexicon = bpe.Lexicon(data)
    assert lexicon.find(words) == [(i, i + 1) for i in range(len(words))]
    absent = [w + b"z" for w in words[:50]] + [b"", b"zzz", b"a" * 99]
    assert lexicon.find(absent) == [None] * len(absent)
    # minimal: as many states as there are distinct sets of endings
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert int(data[1]) == len(endings)
    assert bpe.Lexicon(bpe.compile_lexicon({})).find([b"a"]) == [None]


def test_query_matches_the_library(spark, sf, texts, tokenizer):
    rows = bpe.op3_bpe_transducer(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        plain = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest())


def test_edges_and_round_trip(table):
    rows = [(1, None, "s"), (2, "", "s"), (None, "Hello world", "s"), (3, "x y " * 50000, "s"), (3, "x y " * 50000, "s")]
    df = table(rows)
    coded = bpe.encode(df, bpe.vocabulary_path())
    sizes = sorted(((r.doc_id, r.n_tokens) for r in coded.select("doc_id", "n_tokens").collect()), key=str)
    assert sizes[:2] == [(1, 0), (2, 0)] and len(sizes) == 5
    back = {r.doc_id: r.decoded for r in bpe.decode(coded, bpe.vocabulary_path()).collect()}
    assert back == {1: "", 2: "", None: "Hello world", 3: "x y " * 50000}
    assert bpe.encode(df.limit(0), bpe.vocabulary_path()).count() == 0


def test_digester_writes_the_ids_and_decoded_text_of_the_encoder(tables):
    rng = random.Random(9)
    parts = ["word", " a", "\n", "\n\n", "  ", "\t", "é", "漢字", "😀", "'ll", "12", "\x00", "<|endoftext|>", "", "\u00a0", "x" * 90, *tables.special]
    texts = ["", " ", "\nfirst", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300))]
    plain, digests = bpe.Encoder(tables, None), bpe.Digester(tables, None)
    for want, got in zip(plain.encode(texts), digests.encode(texts)):
        for ids, (written, text) in zip(want, got, strict=True):
            assert written == "".join(f"{i}," for i in ids)
            assert text == b"".join(tables.bytes_of[i] for i in ids).decode("utf-8", "replace")
    assert not digests.decoded
    # a vocabulary whose tokens decode to other bytes
    byte = tables.bytes_of[tables.byte_ids[ord("z")]]
    tables.bytes_of[tables.byte_ids[ord("z")]] = b"?"
    try:
        assert [text for _, text in next(bpe.Digester(tables, None).encode(["1z9\n 1z\x01z"]))] == ["1?9\n 1?\x01?"]
    finally:
        tables.bytes_of[tables.byte_ids[ord("z")]] = byte
