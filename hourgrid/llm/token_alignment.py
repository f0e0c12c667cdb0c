"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide counts of aligned id pairs.

1. A text is cut before each single space between other characters, where neither
   tokenizer merges across. The units between are encoded by a byte-level BPE (A, with
   a space before each) and by a sentencepiece model (B, which adds one).
2. Byte lengths of the tokens add up to their ends. The ends of each side are keys of
   a dictionary to token numbers; the keys that both hold, sorted, slice both id
   lists into groups, and the links of each slice are expanded: all pairs if one side
   is a single token, else those that overlap by their ends. All units that a task
   has not met are aligned together, and each is remembered with its result.
3. A document keeps its distinct linked pairs with their number, in one row. Pairs are
   counted by documents with map-side sums. Counts go back to the documents: the most
   frequent pairs, at most ``HOT``, are broadcast; the others meet the documents that
   hold them in a join by pair, whose keys can't be hot as the hot ones are gone.
   The highest count of each A id has one row per entry of A's vocabulary.

Defined results: null and empty texts, and texts that a tokenizer does not give back
byte by byte, have no tokens: zeros and an empty ``groups_sha256``. Repeated rows and
null ids are documents of their own; an empty table gives no rows; other columns,
whatever their names, are not read. A task holds up to ``MEMO`` units, and of very
long texts ``CHUNK`` characters and the distinct pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.bpe import _byte_of_char, vocabulary_path
from hourgrid.llm.common import read
from hourgrid.session import materialize

#: Characters cut into units at once; units remembered by a task, and their characters.
CHUNK, MEMO, MEMO_CHARS = 1 << 18, 500_000, 1 << 25
#: Pairs broadcast at most (16 bytes each, some 10 MB in a hash table).
HOT = 200_000
_SAFE_CUT = r"(?<=\S) (?=\S)"


class Tokenizers:
    """Both tokenizers with the bytes of their tokens; loaded by each task from the vocabulary files."""

    def __init__(self, bpe_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        self.a = Tokenizer.from_file(bpe_path)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        alphabet = _byte_of_char()
        with open(bpe_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.bytes_a = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in spec["model"]["vocab"].items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := byte(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.size_b = len(pieces)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        #: no piece of B goes on after its first other character into a space, so units are encoded alike
        self.cut = None if any("▁" in p.lstrip("▁") for p in pieces) else re.compile(_SAFE_CUT)
        texts = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
        self.text_a = (texts(len(self.bytes_a), ","), texts(len(self.bytes_a), "|"))
        self.text_b = (texts(self.size_b, ","), texts(self.size_b, ";"))

    def blocks(self, text: str, chunk: int):
        """Blocks of about ``chunk`` characters, cut where units are cut; all but the first without the space before them."""
        at = 0
        while self.cut and len(text) - at > chunk and (m := self.cut.search(text, at + chunk)):
            yield text[at:m.start()]
            at = m.start() + 1
        yield text[at:] if at else text

    def units(self, block: str) -> list[str]:
        return self.cut.split(block) if self.cut else [block]

    def together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and B of units that join to a text with the same cuts, and how many of them each has; None if a unit is not given back."""
        text = " ".join(units)
        want = (" " + text).encode()
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return None
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends = np.cumsum([1 + (len(u) if u.isascii() else len(u.encode())) for u in units])
        stops = [np.searchsorted(np.cumsum(size[ids]), ends, side="right") for size, ids in ((self.sizes_a, a), (self.sizes_b, b))]
        return a, b, *(np.diff(np.append(0, stop)) for stop in stops)

    def encode(self, units: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B of each unit; None where either does not give the unit back."""
        spaced = [" " + u for u in units]
        out: list[tuple[list[int], list[int]] | None] = []
        by_a, by_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for text, a, b in zip(spaced, self.a.encode_batch_fast(spaced, add_special_tokens=False), self.b.encode(units)):
            want, a = text.encode(), a.ids
            out.append((a, b) if b"".join(map(by_a, a)) == want == b"".join(map(by_b, b)) else None)
        return out


def slices(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens of either side up to each common end, in order."""
    at_a, at_b = ({e: i for i, e in enumerate(ends.tolist(), 1)} for ends in (ends_a, ends_b))
    common = sorted(at_a.keys() & at_b.keys())
    return tuple(np.fromiter(map(at.__getitem__, common), dtype=np.int64, count=len(common)) for at in (at_a, at_b))


def links_of(cut_a: np.ndarray, cut_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (of A, of B) of all links, expanded slice by slice."""
    low_a, low_b = (np.append(0, c)[:-1] for c in (cut_a, cut_b))
    n_a, n_b = cut_a - low_a, cut_b - low_b
    single = (n_a == 1) | (n_b == 1)
    size = np.maximum(n_a, n_b)[single]
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    left = [np.repeat(low_a[single], size) + np.where(np.repeat(n_a[single] > 1, size), step, 0)]
    right = [np.repeat(low_b[single], size) + np.where(np.repeat(n_b[single] > 1, size), step, 0)]
    many = np.nonzero(~single)[0]
    if len(many):
        x, y = [], []
        for i, stop_a, j, stop_b in zip(low_a[many].tolist(), cut_a[many].tolist(), low_b[many].tolist(), cut_b[many].tolist()):
            while i < stop_a and j < stop_b:
                x.append(i)
                y.append(j)
                e, f = ends_a[i], ends_b[j]
                i += e <= f
                j += f <= e
        left.append(np.array(x, dtype=np.int64))
        right.append(np.array(y, dtype=np.int64))
    return np.concatenate(left), np.concatenate(right)


def group_words(tokens: Tokenizers, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
    """The ids of each slice in order: ``a1,`` ``a2|`` ``b1;`` and so on."""
    last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    last_a[cut_a - 1], last_b[cut_b - 1] = True, True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    words = np.empty(len(a) + len(b), dtype=object)
    # a token stands after its side's tokens before it and the other side's tokens of the slices before (for B: and of its own)
    place_a = np.arange(len(a)) + np.append(0, cut_b)[group_a]
    place_b = np.arange(len(b)) + cut_a[group_b]
    words[place_a] = np.where(last_a, tokens.text_a[1][a], tokens.text_a[0][a])
    words[place_b] = np.where(last_b, tokens.text_b[1][b], tokens.text_b[0][b])
    return words


class Aligner:
    """Aligns texts unit by unit; remembers units."""

    def __init__(self, tokens: Tokenizers):
        self.tokens = tokens
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.said: list[str] = []                       # ids of the unit's groups, with a semicolon after each
        self.counts = np.zeros((1024, 4), dtype=np.int64)   # n_a, n_b, n_groups, n_links; -1: not given back
        self.pairs, self.first, self.used, self.chars = np.zeros(4096, dtype=np.int64), np.zeros(1025, dtype=np.int64), 0, 0

    def learn(self, units: list[str]) -> None:
        """Align new units together: they stand one behind the other, so every unit's end is a common end."""
        tokens, n = self.tokens, len(self.said)
        # joined by spaces, units with white space at their edges would be cut otherwise; a text that B can't give back is known by its mark
        plain = [u for u in units if not (u[0].isspace() or u[-1].isspace() or "▁" in u)] if tokens.cut else []
        joined = tokens.together(plain) if plain else None
        if joined is None:
            plain = []
        odd = sorted(set(units).difference(plain))
        units, coded = plain + odd, tokens.encode(odd)
        a, b, size_a, size_b = joined or (np.zeros(0, dtype=np.int64),) * 4
        a, b = (np.append(ids, [i for c in coded if c for i in c[k]]).astype(np.int64) for k, ids in enumerate((a, b)))
        size_a, size_b = (np.append(size, [len(c[k]) if c else 0 for c in coded]).astype(np.int64) for k, size in enumerate((size_a, size_b)))
        ends_a, ends_b = np.cumsum(tokens.sizes_a[a]), np.cumsum(tokens.sizes_b[b])
        cut_a, cut_b = slices(ends_a, ends_b)
        x, y = links_of(cut_a, cut_b, ends_a.tolist(), ends_b.tolist())
        stop_a, stop_b = np.cumsum(size_a), np.cumsum(size_b)
        owner = np.searchsorted(stop_a, x, side="right")
        groups = np.diff(np.append(0, np.searchsorted(cut_a, stop_a, side="right")))
        links = np.bincount(owner, minlength=len(units))
        order = np.argsort(owner, kind="stable")
        words = group_words(tokens, a, b, cut_a, cut_b).tolist()
        at = 0
        for stop in (stop_a + stop_b).tolist():
            self.said.append("".join(words[at:stop]))
            at = stop
        self.counts = _room(self.counts, n + len(units))
        self.counts[n:n + len(units)] = np.stack([size_a, size_b, groups, links], axis=1)
        self.counts[n + len(plain) + np.array([i for i, c in enumerate(coded) if c is None], dtype=np.int64)] = -1
        self.pairs = _room(self.pairs, self.used + len(x))
        self.pairs[self.used:self.used + len(x)] = (a[x] * tokens.size_b + b[y])[order]
        self.first = _room(self.first, n + len(units) + 1)
        self.first[n + 1:n + len(units) + 1] = self.used + np.cumsum(links)
        self.used += len(x)
        self.chars += sum(map(len, units))
        self.number.update(zip(units, range(n, n + len(units))))

    def block(self, units: list[str]) -> np.ndarray:
        """Numbers of the units, new ones learnt."""
        found = list(map(self.number.get, units))
        if None in found:
            new = {u for u, n in zip(units, found) if n is None}
            if len(self.number) + len(new) > MEMO or self.chars > MEMO_CHARS:
                self.forget()
                self.learn(list(set(units)))
                found = list(map(self.number.__getitem__, units))
            else:
                self.learn(list(new))
                known = self.number
                found = [known[u] if n is None else n for u, n in zip(units, found)]
        return np.array(found, dtype=np.int64)

    def align_all(self, texts: list[str | None], chunk: int = CHUNK, groups: bool = False):
        """``align`` of each text; units of texts of about ``chunk`` characters in all are learnt together."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= chunk or len(held) > 1000:
                yield from self._some(held, chunk, groups)
                held, size = [], 0
        yield from self._some(held, chunk, groups)

    def _some(self, texts: list[str | None], chunk: int, groups: bool):
        cut = [self.tokens.units(t) if t and len(t) <= chunk else () for t in texts]
        numbers = self.block([u for units in cut for u in units])
        stops = np.cumsum([len(units) for units in cut])
        long = [self.align(t, chunk, groups) if t and len(t) > chunk else None for t in texts] if any(t and len(t) > chunk for t in texts) else None
        if long:  # other units may have been learnt in their place since
            numbers = self.block([u for units in cut for u in units])
        for i, (text, units, stop) in enumerate(zip(texts, cut, stops.tolist())):
            yield long[i] if long and long[i] else self.align(text, chunk, groups, numbers[stop - len(units):stop] if units else None)

    def align(self, text: str | None, chunk: int = CHUNK, groups: bool = False, numbers: np.ndarray | None = None) -> tuple:
        """(n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, number of each[, text of the groups])."""
        nothing = np.zeros(0, dtype=np.int64)
        zeros = (0, 0, 0, 0, "", nothing, nothing, *[""] * groups)
        if not text:
            return zeros
        counts, digest, pairs, times, shown, between = np.zeros(4, dtype=np.int64), hashlib.sha256(), [], [], [], ""
        for at in [numbers] if numbers is not None else (self.block(self.tokens.units(b)) for b in self.tokens.blocks(text, chunk)):
            rows = self.counts[at]
            if (rows[:, 0] < 0).any():
                return zeros
            counts += rows.sum(axis=0)
            said = "".join(map(self.said.__getitem__, at.tolist()))[:-1]
            digest.update((between + said).encode())
            between = ";"
            if groups:
                shown.append(said)
            kinds, often = np.unique(at, return_counts=True)
            size = self.counts[kinds, 3]
            place = np.repeat(self.first[kinds] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            pairs.append(self.pairs[place])
            times.append(np.repeat(often, size))
            if len(pairs) > 16:  # a very long text holds its distinct pairs alone
                pairs, times = ([x] for x in _summed(pairs, times))
        return (*counts.tolist(), digest.hexdigest(), *_summed(pairs, times), *[";".join(shown)] * groups)


def _room(held: np.ndarray, size: int) -> np.ndarray:
    """``held``, or twice as much of it if it has no room for ``size`` rows."""
    if size <= len(held):
        return held
    more = np.zeros((max(size, 2 * len(held)), *held.shape[1:]), dtype=held.dtype)
    more[:len(held)] = held
    return more


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.concatenate(pairs), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(times), minlength=len(found)).astype(np.int64)


def aligned(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (A id x size of B + B id), times; with
    ``groups`` also the text of the groups."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *["groups"] * groups]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())] + [pa.string()] * groups

    def run(batches):
        aligner = Aligner(Tokenizers(bpe_path, piece_path))
        for batch in batches:
            start, held, size = 0, [], 0
            for i, row in enumerate(aligner.align_all(batch.column(1).to_pylist(), groups=groups)):
                held.append(row)
                size += len(held[-1][5])
                if size > 500_000 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, i + 1 - start), *[pa.array([h[c] for h in held], kind) for c, kind in enumerate(kinds)]],
                        names=["doc_id", *names])
                    start, held, size = i + 1, [], 0

    types = ", ".join(f"{n} {t}" for n, t in zip(names, ["long"] * 4 + ["string", "array<long>", "array<int>", "string"]))
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, {types}")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked; whether no pair of its A id is held by more."""
    counts = materialize(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    first = F.expr(f"pair div {size_b}")
    # one row per entry of A's vocabulary
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", first).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(rows: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """``rows`` (one per document, with a unique ``row``) with n_best and count_sum over their links."""
    counts = materialize(counts, "pair-counts")
    # the least count that at most ``hot`` pairs reach, from a histogram of some hundred levels
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    held, least = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("n")).orderBy(F.desc("level")).collect():
        held += r["pairs"]
        if held > hot:
            break
        least = r["n"]
    is_hot = F.col("n") >= least if least else F.lit(False)
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    met = links.join(F.broadcast(counts.where(is_hot)), "pair", "left")
    near = met.where("n IS NOT NULL").groupBy("row").agg(*sums)
    far = met.where("n IS NULL").select("row", "pair", "times").join(counts.where(~is_hot), "pair").groupBy("row").agg(*sums)
    both = near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return rows.join(both, "row", "left").withColumns({c: F.coalesce(c, none) for c in ("n_best", "count_sum")})


def align_documents(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: the columns of ``aligned`` but for pairs, with n_best and count_sum."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    # numbers given in the scan are stored with the rows, so that later reads see the same ones
    rows = materialize(aligned(docs, bpe_path, piece_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    return with_counts(rows, pair_counts(rows, size_b), hot).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_end_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
