from tokenizers import Tokenizer

from hourgrid.llm import bpe


def test_long_words_in_the_automaton():
    words = sorted({b"a" * 5000, b"a" * 4999 + b"b", b"=" * 600, b"a", "語".encode() * 170})
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: (i, i + 1) for i, w in enumerate(words)}))
    assert lexicon.find([*words, b"a" * 4999]) == [*((i, i + 1) for i in range(len(words))), None]


def test_repeated_long_words(table):
    texts = ["x " + "a" * 5000 + " x", "=" * 500 + " y " + "語" * 170, "ab" * 120]
    df = table([(i, text, "s") for i, text in enumerate(texts) for _ in range(4)])
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    rows = bpe.encode(df, bpe.vocabulary_path()).collect()
    assert len(rows) == 4 * len(texts)
    for r in rows:
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
