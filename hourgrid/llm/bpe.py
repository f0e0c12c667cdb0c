"""Byte-level BPE with a minimal acyclic transducer as lexicon of frequent words.

1. Words (the pieces that byte-level BPE merges within) are counted over all
   texts. Each task keeps one table of units between spaces; when it holds
   ``UNITS`` units it is written out, without the units seen once in it, so a
   count is short by at most one per table written.
2. The most frequent words, at most ``LEXICON`` and of at most ``LONGEST`` bytes, are merged on the driver and compiled into
   a minimal acyclic automaton: words share prefixes and suffixes. Arc outputs
   add up to a word's number, which leads to its ids. It is written once to the
   shared folder, sent to every executor as a file, and memory-mapped there.
3. Tasks look new words up in the automaton, all of a batch at once, and merge the
   words that it lacks exactly by the merge ranks (a heap, also for very long ones).

Results are those of the ``tokenizers`` library without added special tokens:
special tokens that occur in a text are cut out first and keep their own id.

Defined results: a null text is empty and has no ids; repeated rows and null ids
of documents are encoded like any other row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import re
import uuid
from collections import Counter
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import read
from hourgrid.session import checkpoint_dir, materialize

LEXICON, UNITS = 100_000, 300_000
#: Words of more bytes are not taken into the lexicon, which the driver holds; they are merged like other words that it lacks.
LONGEST = 256
#: Characters encoded at once; units remembered by a task (some 250 bytes each), half of them as the older ones.
CHUNK, MEMO = 1 << 20, 500_000
_SHORT = 64  # words up to this many bytes are merged together, longer ones by a heap
_NONE = np.int64(2**62)
# fixed values: white space of the split pattern, and the pattern
_SPACE = r"\t-\r \x85\xa0  -     　"
_PIECE = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
          rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Texts in which units can't be cut at single spaces and line ends alone.
_KNOTTY = r"\s\s|[^\S \n]|\x00"
_SAFE_CUT = r"(?<=\S) (?=\S)"


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Merge tables of a vocabulary file; small, sent to the tasks with their code."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], _byte_of_char()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = [0] * 256
        for c, b in alphabet.items():
            self.byte_ids[b] = vocab[c]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[a] << 20) | vocab[b], (rank, vocab[a + b]))
        self.texts = [str(i) for i in range(size)]
        self.comma_texts = [f"{i}," for i in range(size)]
        keys = sorted(self.merges)
        self.pair_keys = np.array(keys, dtype=np.int64)
        self.pair_ranks = np.array([self.merges[k][0] for k in keys], dtype=np.int64)
        self.merged = np.zeros(len(spec["model"]["merges"]), dtype=np.int64)
        for rank, new in self.merges.values():
            self.merged[rank] = new
        self.byte_array = np.array(self.byte_ids, dtype=np.int64)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words: the pair of lowest rank first, the leftmost of equal ones."""
        short = [i for i, w in enumerate(words) if 0 < len(w) <= _SHORT]
        out: list[tuple[int, ...]] = [()] * len(words)
        for i, ids in zip(short, self._together([words[i] for i in short])):
            out[i] = ids
        for i, w in enumerate(words):
            if len(w) > _SHORT:
                out[i] = tuple(self._heap([self.byte_ids[b] for b in w]))
        return out

    def _place(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """rank * 64 + position for pairs that merge, _NONE for others."""
        key = (left << 20) | right
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[i] == key, (self.pair_ranks[i] << 6) | at, _NONE)

    def _together(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """One merge in every word at a time, until no word has a pair left."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        start = np.cumsum(sizes) - sizes
        ids = self.byte_array[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(ids)
        local = np.arange(n) - np.repeat(start, sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[start + sizes - 1], before[start] = -1, -1
        best = np.full(n, _NONE)
        has = np.nonzero(after >= 0)[0]
        best[has] = self._place(ids[has], ids[has + 1], local[has])
        while True:
            low = np.minimum.reduceat(best, start)
            busy = np.nonzero(low < _NONE)[0]
            if not len(busy):
                break
            i = start[busy] + (low[busy] & 63)
            j = after[i]
            k = after[j]
            ids[i], ids[j], best[j] = self.merged[low[busy] >> 6], -1, _NONE
            after[i] = k
            more = k >= 0
            before[k[more]] = i[more]
            best[i] = _NONE
            best[i[more]] = self._place(ids[i[more]], ids[k[more]], local[i[more]])
            h = before[i]
            more = h >= 0
            best[h[more]] = self._place(ids[h[more]], ids[i[more]], local[h[more]])
        kept = ids >= 0
        stop = np.cumsum(np.add.reduceat(kept.astype(np.int64), start)).tolist()
        flat = ids[kept].tolist()
        return [tuple(flat[x:y]) for x, y in zip([0, *stop], stop)]

    def _heap(self, ids: list[int]) -> list[int]:
        get, n = self.merges.get, len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i] << 20) | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], right[i] = new, -1, right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (m := get((ids[x] << 20) | ids[y])):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [i for i in ids if i >= 0]


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> np.ndarray:
    """The automaton of the words as one array: header, arcs (key, target, output), finals, offsets, ids.

    Words are added in order; the states of a finished suffix are replaced by an
    equal state if there is one, which keeps the automaton minimal throughout.
    """
    words = sorted(entries)
    arcs: list[dict[int, int]] = [{}]
    final, register = [False], {}

    def settle(path: list[tuple[int, int, int]], keep: int) -> None:
        while len(path) > keep:
            parent, byte, state = path.pop()
            seen = register.setdefault((final[state], tuple(arcs[state].items())), state)
            arcs[parent][byte] = seen

    path, last = [], b""
    for word in words:
        common = next((i for i, (x, y) in enumerate(zip(word, last)) if x != y), min(len(word), len(last)))
        settle(path, common)
        state = path[-1][2] if path else 0
        for byte in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[state][byte] = len(arcs) - 1
            path.append((state, byte, len(arcs) - 1))
            state = len(arcs) - 1
        final[state], last = True, word
    settle(path, 0)
    number, order, todo = {0: 0}, [0], [0]
    while todo:
        for target in arcs[todo.pop()].values():
            if target not in number:
                number[target] = len(order)
                order.append(target)
                todo.append(target)
    below: dict[int, int] = {}

    todo = [0]
    while todo:  # a state is counted after all that its arcs lead to
        state = todo[-1]
        missing = [t for t in arcs[state].values() if t not in below]
        if missing:
            todo += missing
        else:
            below[todo.pop()] = final[state] + sum(below[t] for t in arcs[state].values())
    rows = []
    for state in order:
        passed = int(final[state])
        for byte, target in sorted(arcs[state].items()):
            rows.append(((number[state] << 8) | byte, number[target], passed))
            passed += below[target]
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 3)
    ids = [entries[w] for w in words]
    offsets = np.cumsum([0] + [len(x) for x in ids])
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(offsets[-1]))
    longest = max(map(len, words), default=0)
    head = np.array([len(table), len(order), len(words), longest], dtype=np.int64)
    return np.concatenate([head, table[:, 0], table[:, 1], table[:, 2], np.array([final[s] for s in order], dtype=np.int64), offsets, flat])


class Lexicon:
    """Look-ups in the compiled (memory-mapped) automaton."""

    def __init__(self, data: np.ndarray):
        n, states, words, self.longest = (int(x) for x in data[:4])
        parts = np.cumsum([4, n, n, n, states, words + 1])
        self.keys, self.target, self.output, self.final, self.offsets = (data[a:b] for a, b in zip(parts, parts[1:]))
        self.ids = data[parts[-1]:]

    def find(self, words: list[bytes]) -> list[tuple[int, ...] | None]:
        """Ids of every word, None for words that it lacks; all words take a step together."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        alive = np.nonzero((sizes > 0) & (sizes <= self.longest))[0] if len(self.keys) else np.zeros(0, dtype=np.int64)
        found: list[tuple[int, ...] | None] = [None] * len(words)
        step = 0
        while len(alive):
            key = (state[alive] << 8) | flat[start[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
            number[alive] += self.output[at]
            step += 1
            ended = sizes[alive] == step
            over = alive[ended]
            for i in over[self.final[state[over]] == 1].tolist():
                a, b = self.offsets[number[i]], self.offsets[number[i] + 1]
                found[i] = tuple(self.ids[a:b].tolist())
            alive = alive[~ended]
        return found


class Encoder:
    """Encodes texts of a task; remembers units between spaces, about ``MEMO`` of them.

    When half of ``MEMO`` is full it becomes the older half, whose units come back when they are seen again.
    """

    def __init__(self, bpe: Bpe, lexicon: Lexicon | None):
        self.bpe, self.lexicon = bpe, lexicon
        self.units = self.special_units()
        self.older: dict = {}
        self.pieces = regex.compile(_PIECE).findall
        self.knotty, self.safe_cut = re.compile(_KNOTTY).search, re.compile(_SAFE_CUT).search
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(bpe.special, key=len, reverse=True))) + ")") if bpe.special else None

    def special_units(self) -> dict:
        return {w: self.packed(w, (i,)) for w, i in self.bpe.special.items()}

    def packed(self, word: str, ids: tuple[int, ...]):
        """What is remembered of a word."""
        return ids

    def joined(self, found, units: list[str]):
        """What is yielded of a segment, from what is remembered of its units."""
        return list(chain.from_iterable(found))

    def segments(self, text: str):
        """Parts of at most about CHUNK characters that can be encoded on their own; special tokens apart."""
        parts = self.special.split(text) if self.special and any(s in text for s in self.bpe.special) else [text]
        for part in parts:
            at = 0
            while part not in self.bpe.special and len(part) - at > CHUNK and (cut := self.safe_cut(part, at + CHUNK)):
                yield part[at:cut.start()]
                at = cut.start()
            yield part[at:] if at else part

    def units_of(self, segment: str) -> list[str]:
        if segment in self.bpe.special:
            return [segment]
        if self.knotty(segment):
            return self.pieces(segment)
        return segment.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def remember(self, units: set[str]) -> None:
        """Make sure that all of ``units`` are remembered: new ones are looked up together."""
        memo = self.units
        new = [u for u in units if u not in memo]
        if not new:
            return
        if len(memo) + len(new) > MEMO // 2:
            self.older = memo
            memo = self.units = self.special_units()
            new = [u for u in units if u not in memo]
        if older := self.older:
            memo.update([(u, older[u]) for u in new if u in older])
            new = [u for u in new if u not in memo]
        # a run of ASCII letters, with one space before it or not, is one piece
        cut = {u: self.pieces(u) for u in new if not (u.isascii() and u.removeprefix(" ").isalpha())}
        words = [u for u in new if u not in cut]
        words += set(chain.from_iterable(cut.values())).difference(memo, words)
        raw = [w.encode() for w in words]
        known = self.lexicon.find(raw) if self.lexicon else [None] * len(raw)
        unseen = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(unseen, self.bpe.merge([raw[i] for i in unseen])):
            known[i] = ids
        memo.update(zip(words, map(self.packed, words, known)))
        get = memo.__getitem__
        for unit, parts in cut.items():
            memo[unit] = get(parts[0]) if len(parts) == 1 else self.strung(map(get, parts))

    def strung(self, parts):
        """What is remembered of a unit of several words."""
        return tuple(chain.from_iterable(parts))

    def encode(self, texts: list[str]):
        """Yield, for each text, its ids as lists (see :meth:`joined`), one per segment; texts are taken in groups of about CHUNK characters."""
        group, size = [], 0
        for text in texts:
            if len(text) > CHUNK:  # segment by segment, so that only one is held
                yield from self._group(group)
                group, size = [], 0
                yield (ids for segment in self.segments(text) for ids in next(self._group([segment])))
                continue
            group.append(text)
            size += len(text)
            if size > CHUNK:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]):
        cut = [[self.units_of(segment) for segment in self.segments(text)] for text in texts]
        self.remember(set(chain.from_iterable(chain.from_iterable(cut))))
        get = self.units.__getitem__
        for segments in cut:
            yield [self.joined(map(get, part), part) for part in segments]


class Digester(Encoder):
    """Encodes for digests: yields, per segment, its decimal ids, each with a comma after it, and its decoded text.

    Both are written once per remembered word instead of once per place. A word's ids are decoded when it is
    first seen; only where that gives another text than the word itself is it kept apart.
    """

    def __init__(self, bpe: Bpe, lexicon: Lexicon | None):
        self.decoded: dict[str, str] = {}
        super().__init__(bpe, lexicon)

    def packed(self, word: str, ids: tuple[int, ...]) -> str:
        text = b"".join(map(self.bpe.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        if text != word:
            self.decoded[word] = text
        return "".join(map(self.bpe.comma_texts.__getitem__, ids))

    def strung(self, parts) -> str:
        return "".join(parts)

    def joined(self, found, units: list[str]) -> tuple[str, str]:
        if self.decoded:
            other, words = self.decoded, self.pieces
            units = [other.get(w, w) for u in units for w in ([u] if u in self.bpe.special else words(u))]
        return "".join(found), "".join(units)


def count_words(docs: DataFrame, text_col: str = "text", units: int = UNITS) -> DataFrame:
    """(word, n): words of all texts, without those seen once in a task's table."""

    def run(batches):
        pieces = regex.compile(_PIECE).findall
        seen: Counter = Counter()

        def flush():
            words: Counter = Counter()
            for unit, n in seen.items():
                if n > 1:
                    for w in pieces(" " + unit):
                        words[w] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                found = iter((text.as_py() or "").split())
                while part := list(islice(found, 100_000)):
                    seen.update(part)
                    if len(seen) > units:
                        yield flush()
        yield flush()

    counted = docs.select(docs[text_col].alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, bpe: Bpe, text_col: str = "text", size: int = LEXICON) -> str:
    """Compile the most frequent words of ``docs``; returns the name of the file that executors hold."""
    from pyarrow import fs

    spark = docs.sparkSession
    counted = materialize(count_words(docs, text_col).where(F.octet_length("word") <= LONGEST), "words")
    # the least count that at most ``size`` words reach, from a histogram of some hundred rows
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    held, least = 0, None
    for row in counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).orderBy(F.desc("level")).collect():
        held += row["words"]
        if held > size:
            break
        least = row["n"]
    top = counted.where(F.col("n") >= least).select("word").collect() if least else []
    words = [w for w in (r["word"].encode() for r in top) if w]
    data = compile_lexicon(dict(zip(words, bpe.merge(words))))
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    folder = checkpoint_dir(spark).rstrip("/")
    store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        buffer = io.BytesIO()
        np.save(buffer, data)
        out.write(buffer.getvalue())
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           columns: tuple[str, ...] = ("n_tokens", "ids"), size: int = LEXICON) -> DataFrame:
    """One row per document: doc_id and the wanted ``columns`` out of n_tokens, ids, decoded,
    ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of the decoded text)."""
    bpe = Bpe(vocabulary)
    name = build_lexicon(docs, bpe, text_col, size)
    kinds = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)
    arrow = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}

    def run(batches):
        tables = shared.value
        only_digests = not {"ids", "decoded"}.intersection(columns)
        encoder = (Digester if only_digests else Encoder)(tables, Lexicon(np.load(SparkFiles.get(name), mmap_mode="r")))
        texts_of, bytes_of = tables.texts.__getitem__, tables.bytes_of.__getitem__

        def row(segments):
            n, ids, digest, plain, parts = 0, [], hashlib.sha256(), hashlib.sha256(), []
            for part in segments:
                if "ids_sha256" in columns and part:
                    digest.update(((b"," if n else b"") + ",".join(map(texts_of, part)).encode()))
                if "ids" in columns:
                    ids += part
                if "decoded" in columns:
                    parts.append(b"".join(map(bytes_of, part)))
                if "decoded_sha256" in columns:
                    # segments of a text end at character bounds, so each decodes on its own
                    plain.update(b"".join(map(bytes_of, part)).decode("utf-8", "replace").encode())
                n += len(part)
            return {"n_tokens": n, "ids": ids, "decoded": b"".join(parts).decode("utf-8", "replace"),
                    "ids_sha256": digest.hexdigest(), "decoded_sha256": plain.hexdigest()}

        def digests(segments):
            n, last, digest, plain = 0, "", hashlib.sha256(), hashlib.sha256()
            for ids, text in segments:
                if ids:
                    # the comma after the last id is left out
                    digest.update((last + ids[:-1]).encode())
                    n, last = n + ids.count(","), ","
                plain.update(text.encode())
            return {"n_tokens": n, "ids_sha256": digest.hexdigest(), "decoded_sha256": plain.hexdigest()}

        row_of = digests if only_digests else row
        for batch in batches:
            start, held = 0, []
            texts = (text.as_py() or "" for text in batch.column(1))
            for i, segments in enumerate(encoder.encode(texts)):
                held.append(row_of(segments))
                if i + 1 - start >= 2000 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, i + 1 - start), *[pa.array([h[c] for h in held], arrow[c]) for c in columns]],
                        names=["doc_id", *columns])
                    start, held = i + 1, []

    fields = ", ".join(f"{c} {kinds[c]}" for c in columns)
    key = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {key}, {fields}")


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of lists of ids; null lists decode to the empty text, unknown ids are an error."""
    shared = tokens.sparkSession.sparkContext.broadcast(Bpe(vocabulary))
    rows = tokens.select(tokens[id_col].alias("doc_id"), tokens[ids_col].cast("array<int>").alias("ids"))

    def run(batches):
        bytes_of = shared.value.bytes_of
        for batch in batches:
            texts = [b"".join(bytes_of[i] for i in ids or ()).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), vocabulary_path(), columns=("n_tokens", "ids_sha256", "decoded_sha256"))
