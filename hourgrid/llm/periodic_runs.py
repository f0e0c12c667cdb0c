"""Periodic runs of words by recompression: a run-length grammar answers exact extensions.

1. The words of a group of documents are numbered and put one behind the other,
   with a separator of its own between any two, which no rule ever takes in.
2. Recompression: in turns, each block of one repeated letter becomes a letter
   (letter, length), and each pair of a left and a right letter, by a hash of the
   letters, becomes a letter. What becomes of a letter depends on its neighbours
   alone, so equal stretches are parsed alike but for their edges.
3. Extensions of (i, j): climb while both positions stand at the edge of a rule,
   consuming a letter or a block where they don't, and descend where letters differ.
   All queries take a step together, O(levels) steps in all, in either direction.
4. Candidates lie on a harmonic grid: a run of period q and length >= 4q holds two
   equal words (i, i + q) with i on the grid of step 3q. n/3 + n/6 + ... pairs are
   compared, and the equal ones extended to both sides by the grammar.
5. Stretches found with a multiple of their period are the same stretch found with
   the period, so the smallest of a stretch's periods is kept.

Defined results: a null or empty text has no words and no runs, and its collapsed
text is empty; repeated rows and null ids are treated like any other row; an empty
table gives no rows; other columns, whatever their names, are not read. A task holds
one group of documents of about ``GROUP`` words, or one longer document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourgrid.llm.common import read

POWER, LEAST = 4, 6
GROUP, CANDIDATES = 200_000, 1_000_000


def _side(letters: np.ndarray, turn: int) -> np.ndarray:
    """A bit per letter: True for left letters of this turn."""
    x = (letters.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return (x * np.uint64(0x94D049BB133111EB)) >> np.uint64(63) == 1


class Grammar:
    """Levels of letters; ``first[t]`` holds where a letter of level t + 1 begins on level t, ``parent[t]`` the way back."""

    def __init__(self, letters: np.ndarray, separators: int):
        """``letters`` begin and end with a separator; letters below ``separators`` are separators, each used once."""
        self.levels, self.first, self.parent, self.block = [letters], [], [], []
        self.used, turn = int(letters.max(initial=0)) + 1, 0
        while True:
            self._blocks()
            s = self.levels[-1]
            free = s >= separators
            if not (free[1:] & free[:-1]).any():
                return
            left = _side(s, turn)
            self._pairs(s, free & left, free & ~left)
            turn += 1

    def _add(self, starts: np.ndarray, letters: np.ndarray, block: bool) -> None:
        self.first.append(np.append(np.nonzero(starts)[0], len(starts)))
        self.parent.append(np.cumsum(starts) - 1)
        self.levels.append(letters)
        self.block.append(block)

    def _blocks(self) -> None:
        s = self.levels[-1]
        starts = np.append(True, s[1:] != s[:-1])
        if starts.all():
            return
        at = np.nonzero(starts)[0]
        size = np.diff(np.append(at, len(s)))
        letters, long = s[at], np.nonzero(size > 1)[0]
        kinds, number = np.unique(letters[long] * (int(size.max()) + 1) + size[long], return_inverse=True)
        letters[long] = self.used + number
        self.used += len(kinds)
        self._add(starts, letters, True)

    def _pairs(self, s: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        pair = np.nonzero(left[:-1] & right[1:])[0]
        if not len(pair):
            return
        starts = np.ones(len(s), dtype=bool)
        starts[pair + 1] = False
        kinds, number = np.unique(s[pair] * self.used + s[pair + 1], return_inverse=True)
        letters = s.copy()
        letters[pair] = self.used + number
        self.used += len(kinds)
        self._add(starts, letters[starts], False)

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many letters from i and from j on (to the right for step 1, to the left for -1) are equal; i < j."""
        a, b = i.copy(), j.copy()
        top = len(self.levels) - 1
        fallen: list[list[np.ndarray]] = [[] for _ in self.levels]
        up = np.arange(len(a))
        for t in range(top):
            rising = []
            while len(up):
                edge = self._edge(t, a[up], step) & self._edge(t, b[up], step)
                rising.append(up[edge])
                up = self._consume(t, up[~edge], a, b, step, fallen[t])
            up = np.concatenate(rising) if rising else up
            a[up], b[up] = self.parent[t][a[up]], self.parent[t][b[up]]
        while len(up):
            up = self._consume(top, up, a, b, step, fallen[top])
        down = np.zeros(0, dtype=np.int64)
        for t in range(top, -1, -1):
            if t < top and len(down):
                for x in (a, b):
                    x[down] = self.first[t][x[down]] if step > 0 else self.first[t][x[down] + 1] - 1
            ended: list[np.ndarray] = fallen[t]
            while len(down):
                down = self._consume(t, down, a, b, step, ended)
            down = np.concatenate(ended) if ended else down
        return np.abs(a - i)

    def _edge(self, t: int, x: np.ndarray, step: int) -> np.ndarray:
        first, parent = self.first[t], self.parent[t][x]
        return first[parent] == x if step > 0 else first[parent + 1] - 1 == x

    def _consume(self, t: int, who: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, ended: list[np.ndarray]) -> np.ndarray:
        """Move over one equal letter (on a level of blocks over the rest of the shorter block); returns those that go on."""
        s = self.levels[t]
        same = s[a[who]] == s[b[who]]
        if not same.all():
            ended.append(who[~same])
            who = who[same]
        if t < len(self.block) and self.block[t]:
            first, parent = self.first[t], self.parent[t]
            rest = [first[parent[x[who]] + 1] - x[who] if step > 0 else x[who] - first[parent[x[who]]] + 1 for x in (a, b)]
            move = step * np.minimum(*rest)
        else:
            move = step
        a[who] += move
        b[who] += move
        return who


def runs_of(documents: list[np.ndarray], letters: int, power: int = POWER, least: int = LEAST) -> list[np.ndarray]:
    """For each document (numbers of its words, below ``letters``) the rows (start, length, period) of its runs, in order."""
    order = sorted(range(len(documents)), key=lambda d: -len(documents[d]))
    sizes = np.array([len(documents[d]) for d in order], dtype=np.int64)
    n, docs = int(sizes.sum()) + len(order) + 1, len(order)
    text = np.zeros(n, dtype=np.int64)
    begin = np.cumsum(np.append(1, sizes + 1))[:-1]
    for d, at in zip(order, begin.tolist()):
        text[at:at + len(documents[d])] = documents[d] + docs + 1
    text[begin - 1] = np.arange(docs)
    text[n - 1] = docs
    found: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64)]
    grammar = None
    held, total = [], 0
    longest = int(sizes[0]) if docs else 0
    ends = (begin + sizes).tolist()
    falling = (-sizes).tolist()

    def settle():
        nonlocal grammar, held, total
        if grammar is None:
            grammar = Grammar(text, docs + 1)
        at = np.concatenate([h[0] for h in held])
        q = np.repeat([h[1] for h in held], [len(h[0]) for h in held])
        start = at - grammar.extend(at - 1, at - 1 + q, -1)
        stop = at + q + grammar.extend(at, at + q, 1)
        good = stop - start >= np.maximum(least, power * q)
        found.append(_smallest(np.stack([start[good], stop[good], q[good]], axis=1)))
        held, total = [], 0

    last = docs
    for q in range(1, longest // power + 1):
        need = max(least, power * q)
        while last and -falling[last - 1] < need:
            last -= 1
        if not last:
            break
        at = np.arange(1, ends[last - 1] - q, need - q)
        at = at[text[at] == text[at + q]]
        if len(at):
            held.append((at, q))
            total += len(at)
            if total >= CANDIDATES:
                settle()
    if held:
        settle()
    rows = _smallest(np.concatenate(found))
    owner = np.searchsorted(begin, rows[:, 0], side="right") - 1
    out = [rows[:0]] * docs
    cut = np.searchsorted(owner, np.arange(docs + 1))
    for k, d in enumerate(order):
        part = rows[cut[k]:cut[k + 1]]
        if len(part):
            start = part[:, 0] - begin[k]
            part = np.stack([start, part[:, 1] - part[:, 0], part[:, 2]], axis=1)
            part = part[np.lexsort((part[:, 2], part[:, 0]))]
        out[d] = part
    return out


def _smallest(rows: np.ndarray) -> np.ndarray:
    """(start, stop, period) with the smallest period of each stretch, in order."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)) if len(rows) else np.zeros(0, dtype=bool)
    return rows[new]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.nonzero(np.cumsum(edge)[:-1] == 0)[0]
    return [words[i] for i in kept.tolist()]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """(start, length, period) of the greatest exact length / period; ties: smallest start, then period."""
    if not len(runs):
        return None
    ratio = runs[:, 1] / runs[:, 2]
    near = runs[ratio >= ratio.max() * (1 - 1e-12)].tolist()
    return tuple(max(near, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])))


_FIELDS = {"n_runs": (pa.int64(), "long"), "runs": (pa.list_(pa.list_(pa.int64())), "array<array<long>>"), "start": (pa.int64(), "long"),
           "length": (pa.int64(), "long"), "period": (pa.int64(), "long"), "exponent_milli": (pa.int64(), "long"), "runs_sha256": (pa.string(), "string"),
           "collapsed": (pa.string(), "string"), "collapsed_sha256": (pa.string(), "string")}


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ("n_runs", "runs", "collapsed"),
              prepare: Callable[[object, list[bytes]], list[bytes]] | None = None, power: int = POWER, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id and the wanted ``columns``: n_runs, runs ([start, length, period] each), the strongest run's
    start, length, period and exponent_milli, collapsed (the text's words without repetitions), and digests of both.
    ``prepare`` may change a document's words (given its id) before they are searched."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def row(words: list[bytes], runs: np.ndarray) -> tuple:
        best, rows = strongest(runs), runs.tolist()
        short = b" ".join(collapse(words, runs)) if "collapsed" in columns or "collapsed_sha256" in columns else b""
        every = {"n_runs": len(rows), "runs": rows, "start": best and best[0], "length": best and best[1], "period": best and best[2],
                 "exponent_milli": best and 1000 * best[1] // best[2],
                 "runs_sha256": hashlib.sha256("".join("%d,%d,%d\n" % tuple(r) for r in rows).encode()).hexdigest(),
                 "collapsed": short.decode() if "collapsed" in columns else None, "collapsed_sha256": hashlib.sha256(short).hexdigest()}
        return tuple(every[c] for c in columns)

    def search(group: list[list[bytes]]) -> list[tuple]:
        number: dict[bytes, int] = defaultdict(count().__next__)
        coded = [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)) for words in group]
        return [row(words, runs) for words, runs in zip(group, runs_of(coded, len(number), power, least))]

    def run(batches):
        for batch in batches:
            keys, start, done, group, size = batch.column(0), 0, [], [], 0
            for i, item in enumerate(batch.column(1)):
                words = (item.as_py() or "").encode().split()  # bytes are split at ASCII white space alone
                group.append(prepare(keys[i].as_py(), words) if prepare else words)
                size += len(group[-1])
                if size >= GROUP or i + 1 == batch.num_rows:
                    done = search(group)
                    group, size = [], 0
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(start, i + 1 - start), *[pa.array([r[c] for r in done], _FIELDS[name][0]) for c, name in enumerate(columns)]],
                        names=["doc_id", *columns])
                    start = i + 1

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} {_FIELDS[c][1]}" for c in columns))


def repeat_some(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The rule of the query: in one of ten documents, by CRC-32 of the id, a stretch is repeated to the end; null ids never."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def op12_recompressed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(read(spark, sf_dir, "documents"), prepare=repeat_some,
                     columns=("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))
