"""Secrets: fixed patterns, and strings that a battery of randomness tests can't tell from random ones.

Kinds ``assign``, ``access`` and ``hex`` are the base: each match of a pattern
that is long enough is a span (for ``assign`` the whole match). The method adds
strings of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_-]`` apart from base spans:

1. The encoding is inferred from the characters used; it gives an alphabet size.
2. Three tests against even, independent symbols: chi-squared of the symbol
   counts, number of runs above and below the alphabet's middle, and lag-1 serial
   correlation. The largest absolute z of the three is the string's statistic.
3. What written text scores is counted on all texts: their letters and digits,
   folded into each alphabet, are cut into strings of each class of lengths and
   pass the same battery. This null distribution and the candidates' own
   are histograms (encoding, length class, z) of a few thousand rows at any size.
4. In each class Benjamini-Hochberg at ``Q`` sets the largest z that is a find:
   short strings need more evidence, as written text passes more often there.

Defined results: a null or empty text has no spans; offsets are code points, the
end exclusive; repeated rows and null ids are judged like any other row; an empty
table gives no rows; other columns, whatever their names, are not read. The time
is in proportion to the text, and a task holds one batch, also for very long texts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import read
from hourgrid.session import materialize

BASE = ("assign", "access", "hex")
SHORTEST, Q = 16, 0.05
#: Encodings by the characters they use, the narrowest that fits is taken; symbols in the order of their values.
ENCODINGS = {
    "hex16": "0123456789abcdef", "hex16u": "0123456789ABCDEF", "low26": "abcdefghijklmnopqrstuvwxyz", "up26": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "b32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "b36": "0123456789abcdefghijklmnopqrstuvwxyz", "b36u": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "b62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "b64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"}
NAMES = tuple(ENCODINGS)
KINDS = (*BASE, *NAMES)
SIZES = tuple(len(ENCODINGS[name]) for name in NAMES)
#: Length classes: a string belongs to the longest one that it reaches.
CLASSES = (16, 20, 24, 32, 48, 64, 96)
#: z is kept in eighths; above ``LIMIT`` a string is not random itself.
STEPS, LIMIT, TOP = 8, 28, 63
CODES = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ENCODINGS.items()}
_ALNUM = ENCODINGS["b62"].encode()

# fixed values: the base patterns; the long runs hold every match of access and hex that is long enough
_ASSIGN = r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = r"AKIA[A-Z0-9]{16,}"
_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"


def encoding_of(run: str) -> int | None:
    """Number of the narrowest encoding whose alphabet holds every symbol; None for digits alone or a mix of both base64 kinds."""
    used = set(run)
    if used <= set("0123456789"):
        return None
    return next((i for i, name in enumerate(NAMES) if used <= CODES[name].keys()), None)


def battery(symbols: np.ndarray, size: int) -> np.ndarray:
    """The statistic of each row of ``symbols`` (values 0 to size - 1): the largest |z| of the three tests, in steps."""
    m, n = symbols.shape
    at = (np.arange(m)[:, None] * size + symbols).ravel()
    counts = np.bincount(at, minlength=m * size).reshape(m, size).astype(np.float64)
    chi = (counts * counts).sum(axis=1) * size / n - n
    z_even = (chi - (size - 1)) / np.sqrt(2.0 * (size - 1) * (n - 1) / n)
    high = symbols >= size / 2
    above = high.sum(axis=1).astype(np.float64)
    below = n - above
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    pairs = 2 * above * below
    spread = np.maximum(pairs * (pairs - n) / (n * n * (n - 1.0)), 1e-12)
    z_runs = np.where((above > 1) & (below > 1), (runs - pairs / n - 1) / np.sqrt(spread), 99.0)
    centred = symbols - symbols.mean(axis=1, keepdims=True)
    power = (centred * centred).sum(axis=1)
    serial = (centred[:, 1:] * centred[:, :-1]).sum(axis=1) / np.maximum(power, 1e-12)
    z_serial = np.where(power > 0, (serial + 1.0 / n) * np.sqrt(n), 99.0)
    worst = np.maximum(np.abs(z_even), np.maximum(np.abs(z_runs), np.abs(z_serial)))
    return np.minimum((worst * STEPS).astype(np.int64), TOP)


def length_class(n: int) -> int:
    return max(i for i, c in enumerate(CLASSES) if c <= n)


class Written:
    """Histogram of the battery over written text: every letter and digit goes into one string."""

    #: One string of each class in each alphabet size.
    CUTS = tuple((size, c) for size in sorted(set(SIZES)) for c in range(len(CLASSES)))
    BLOCK = sum(CLASSES[c] for _, c in CUTS)

    def __init__(self):
        self.counts: Counter = Counter()
        self.rest = np.zeros(0, dtype=np.uint8)
        table = np.full(256, 255, dtype=np.uint8)
        for value, byte in enumerate(_ALNUM):
            table[byte] = value
        self.table = table
        # letters keep their place in the alphabet whatever their case where an encoding has but one case
        fold = np.arange(62)
        fold[26:52] -= 26
        self.folds = {size: (np.arange(62) if size >= 62 else np.where(fold < 52, fold, fold - 52 + 26 * (size >= 36)) % size) for size in set(SIZES)}

    def add(self, text: str) -> None:
        got = self.table[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)]
        self.rest = np.concatenate([self.rest, got[got < 62]])
        if len(self.rest) >= 64 * self.BLOCK:
            self.count(len(self.rest) // self.BLOCK)

    def count(self, blocks: int) -> None:
        rows = self.rest[:blocks * self.BLOCK].reshape(blocks, self.BLOCK)
        self.rest = self.rest[blocks * self.BLOCK:]
        self._rows(rows)

    def _rows(self, rows: np.ndarray) -> None:
        at = 0
        for size, c in self.CUTS:
            cut = rows[:, at:at + CLASSES[c]]
            at += CLASSES[c]
            if cut.shape[1] < CLASSES[c]:
                return
            steps = battery(self.folds[size][cut], size)
            for step, n in enumerate(np.bincount(steps).tolist()):
                if n:
                    self.counts[size, c, step] += n

    def finish(self) -> list[tuple[int, int, int, int]]:
        self.count(len(self.rest) // self.BLOCK)
        if len(self.rest):  # less than a block is left: the strings that it still fills
            self._rows(self.rest[None, :])
            self.rest = self.rest[:0]
        return [(*key, n) for key, n in sorted(self.counts.items())]


class Finder:
    """Base spans and candidates of a text; holds the compiled patterns of a task."""

    def __init__(self):
        self.assign, self.access, self.hex, self.run = (re.compile(p).finditer for p in (_ASSIGN, _ACCESS, _HEX, _RUN))

    def find(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int, int]]]:
        """Base spans (start, kind, end) and candidates (start, encoding, end, class, statistic)."""
        base, lower = [], text.lower()
        if any(w in lower for w in _WORDS):
            base += [(m.start(), 0, m.end()) for m in self.assign(text) if m.end() - m.start(1) >= 6]
        runs = list(self.run(text)) if max(map(len, text.split()), default=0) >= SHORTEST else []
        for m in runs:
            base += [(m.start() + x.start(), 1, m.start() + x.end()) for x in self.access(m[0])]
            base += [(m.start() + x.start(), 2, m.start() + x.end()) for x in self.hex(m[0])]
        base.sort()
        found, i, reach = [], 0, 0
        for m in runs:
            start, end = m.span()
            while i < len(base) and base[i][0] < end:
                reach = max(reach, base[i][2])
                i += 1
            if reach > start or (kind := encoding_of(m[0])) is None:
                continue
            code = CODES[NAMES[kind]]
            symbols = np.fromiter((code[c] for c in m[0]), dtype=np.int64, count=end - start)
            found.append((start, kind, end, length_class(end - start), int(battery(symbols[None, :], SIZES[kind])[0])))
        return base, found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its base spans and candidates; per task one more row with the histogram of written text (``written``)."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    span = [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]
    kinds = {"base": pa.list_(pa.struct(span)), "found": pa.list_(pa.struct([*span, ("class", pa.int32()), ("z", pa.int32())])),
             "written": pa.list_(pa.struct([("size", pa.int32()), ("class", pa.int32()), ("z", pa.int32()), ("n", pa.int64())]))}

    def rows(keys, *columns):
        data = [pa.array([None if r is None else [dict(zip([f.name for f in kind.value_type], x)) for x in r] for r in column], kind)
                for column, kind in zip(columns, kinds.values())]
        return pa.RecordBatch.from_arrays([keys, *data], names=["doc_id", *kinds])

    def run(batches):
        finder, written, key = Finder(), Written(), None
        for batch in batches:
            key = batch.schema.field(0).type
            base, found = [], []
            for item in batch.column(1):
                text = item.as_py() or ""
                a, b = finder.find(text)
                base.append(a)
                found.append(b)
                written.add(text)
            yield rows(batch.column(0), base, found, [None] * batch.num_rows)
        if key is not None:
            yield rows(pa.nulls(1, key), [[]], [[]], [written.finish()])

    span = "start:int,kind:int,end:int"
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, base array<struct<{span}>>, "
                                 f"found array<struct<{span},class:int,z:int>>, written array<struct<size:int,class:int,z:int,n:bigint>>")


def thresholds(scanned: DataFrame, q: float = Q) -> dict[tuple[int, int], int]:
    """(encoding, length class) -> the largest statistic that is a find.

    Benjamini-Hochberg in each class: a string's p is the share of written strings of that class that
    look at least as random. Reads two histograms of at most encodings x classes x 64 rows.
    """
    null = scanned.select(F.explode("written").alias("w")).groupBy("w.size", "w.class", "w.z").agg(F.sum("w.n").alias("n")).collect()
    seen = scanned.select(F.explode("found").alias("f")).groupBy("f.kind", "f.class", "f.z").agg(F.count(F.lit(1)).alias("n")).collect()
    written: dict[tuple[int, int], np.ndarray] = {}
    for r in null:
        written.setdefault((r["size"], r["class"]), np.zeros(TOP + 1))[r["z"]] += r["n"]
    found: dict[tuple[int, int], np.ndarray] = {}
    for r in seen:
        found.setdefault((r["kind"], r["class"]), np.zeros(TOP + 1))[r["z"]] += r["n"]
    out = {}
    for (kind, c), counts in found.items():
        base = written.get((SIZES[kind], c), np.zeros(TOP + 1))
        p = (1 + np.cumsum(base)) / (1 + base.sum())
        reach = np.cumsum(counts)
        ok = np.nonzero((p * counts.sum() <= q * reach) & (np.arange(TOP + 1) < LIMIT))[0]
        if len(ok):
            out[kind, c] = int(ok[-1])
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """One row per document: doc_id, spans (start, kind as a number in KINDS, end) in order."""
    scanned = materialize(scan(docs, id_col, text_col), "secrets")
    finds = thresholds(scanned, q)

    def is_find(f: Column) -> Column:
        hit = F.lit(False)
        for (kind, c), z in finds.items():
            hit = hit | ((f["kind"] == kind) & (f["class"] == c) & (f["z"] <= z))
        return hit

    random = F.transform(F.filter("found", is_find),
                         lambda f: F.struct(f["start"], (f["kind"] + len(BASE)).cast("int").alias("kind"), f["end"]))
    return scanned.where("written IS NULL").select("doc_id", F.array_sort(F.concat("base", random)).alias("spans"))


def op11_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    # one parameter: a second one, also with a default, would be the span's place in the list
    of_kind = lambda i: count(lambda s: s["kind"] == i)
    return found.select(
        "doc_id", *[of_kind(i).alias(f"n_{name}") for i, name in enumerate(BASE)],
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] < len(BASE)), text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        count(lambda s: s["kind"] >= len(BASE)).alias("n_random"))
