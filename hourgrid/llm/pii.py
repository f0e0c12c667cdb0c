"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are the base: a proposal that
passes its check is a span, whatever its score. The kinds ``iban`` (mod 97),
``ssn`` (number ranges) and ``card13`` (13 digits, Luhn) are the method's: a
proposal has a prior by kind, gains from context words within ``WINDOW``
characters, and is a span from ``KEEP`` on. Spans of the method that overlap a
base span, or one of the method with a higher score, are dropped.

Patterns start at the edge of a run of their characters (or, for e-mail, at each
``@``), so the time is in proportion to the text, also for very long runs.

Defined results: a null or empty text has no spans; offsets are code points, the
end exclusive; repeated rows and null ids are judged like any other row; very long
texts are scanned whole; columns beside id and text may have any name and type and
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hourgrid.llm.common import read

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "card13")
WINDOW, KEEP, GAIN = 48, 0.6, 0.35
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.85, "ssn": 0.3, "card13": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "credit", "debit"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security", "tax id", "taxpayer"),
    "card13": ("card", "visa", "payment", "credit", "debit"),
}
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

# fixed values: the base patterns, anchored at run edges, without backtracking
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Looks ahead, as what follows an IBAN may look like a part of it and may be another one.
_IBAN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?))"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"


#: Characters of an IBAN by country.
IBAN_SIZES = {country: size for size, countries in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str, domain) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        free = at + 1
        if size and (m := domain(text, at + 1)):
            found.append((at - size, m.end()))
            free = m.end()
        at = text.find("@", free)
    return found


def _iban_end(text: str, start: int, end: int) -> int:
    """Where the IBAN proposed at [start, end) ends, 0 if the check confirms no end.

    Ends are where a run of letters and digits ends. The length of the country comes first, then
    the longest end and, for a country without a known length, the shorter ones down to 15 characters.
    """
    ends, size = [], IBAN_SIZES.get(text[start:start + 2])
    for e in range(end, start + 14, -1):
        if text[e - 1] != " " and not (text[e:e + 1].isascii() and text[e:e + 1].isalnum()):
            code = text[start:e].replace(" ", "")
            if len(code) == size:
                ends.insert(0, (e, code))
            elif not size or not ends:
                ends.append((e, code))
    return next((e for e, code in ends if 15 <= len(code) <= 34 and mod97(code)), 0)


def _octets(text: str) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in text.split("."))


class Finder:
    """The proposals and their checks; holds the compiled patterns of a task."""

    def __init__(self):
        self.digit = re.compile("[0-9]").search
        self.domain = re.compile(_DOMAIN).match
        self.ip, self.card, self.phone = (re.compile(p).finditer for p in (_IP, _CARD, _PHONE))
        self.iban, self.ssn = (re.compile(p).finditer for p in (_IBAN, _SSN))
        self.cue = {k: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, words)) + ")").search for k, words in CONTEXT.items()}

    def score(self, text: str, kind: str, start: int, end: int) -> float:
        near = (text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]).lower()
        return min(1.0, PRIOR[kind] + GAIN * bool(self.cue[kind](near)))

    def base(self, text: str) -> list[tuple[int, int, str]]:
        """Base spans (start, end, kind), leftmost and non-overlapping within each kind."""
        found = [(a, b, "email") for a, b in _emails(text, self.domain)]
        if not self.digit(text):
            return found
        found += [(m.start(), m.end(), "ip") for m in self.ip(text) if _octets(m[0])]
        for m in self.card(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in self.phone(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
        return found

    def more(self, text: str) -> list[tuple[int, int, str]]:
        """Proposals of the method's own kinds that pass their checks."""
        found = []
        if not self.digit(text):
            return found
        free = 0
        for m in self.iban(text):
            if m.start() >= free and (end := _iban_end(text, m.start(), m.end(1))):
                found.append((m.start(), end, "iban"))
                free = end
        for m in self.ssn(text):
            area, group, serial = m[0].split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                found.append((m.start(), m.end(), "ssn"))
        for m in self.card(text):
            if 13 <= m.end() - m.start() <= 25:
                digits = m[0].replace(" ", "").replace("-", "")
                if len(digits) == 13 and luhn(digits):
                    found.append((m.start(), m.end(), "card13"))
        return found

    def spans(self, text: str) -> list[tuple[str, int, int, float]]:
        """All spans (kind, start, end, score) by start, then by the order of KINDS."""
        base = [(a, b, k, self.score(text, k, a, b)) for a, b, k in self.base(text)]
        extra = [(a, b, k, s) for a, b, k in self.more(text) if (s := self.score(text, k, a, b)) >= KEEP]
        taken = sorted((a, b) for a, b, _, _ in base)
        kept = list(base)
        if extra:
            longest = max((b - a for a, b in taken), default=0)
            own: list[tuple[int, int]] = []
            for a, b, k, s in sorted(extra, key=lambda x: (-x[3], x[0], KINDS.index(x[2]))):
                near = taken[bisect.bisect_left(taken, (a - longest, 0)):bisect.bisect_left(taken, (b, 0))]
                i = bisect.bisect_left(own, (b, 0))
                # spans kept of the method's are apart, so only the last one before can overlap
                if not any(y > a for _, y in near) and not (i and own[i - 1][1] > a):
                    kept.append((a, b, k, s))
                    bisect.insort(own, (a, b))
        order = {k: i for i, k in enumerate(KINDS)}
        return [(k, a, b, s) for a, b, k, s in sorted(kept, key=lambda x: (x[0], order[x[2]], x[1]))]


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans by one, the first's."""
    parts, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end, score)."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches):
        finder = Finder()
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in finder.spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], names=["doc_id", "spans"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text column replaced by its kind; all other columns as they were."""
    at = docs.columns.index(text_col)

    def run(batches):
        finder = Finder()
        for batch in batches:
            texts = [None if (s := t.as_py()) is None else redacted(s, finder.spans(s)) for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    # numbered names inside: a name may hold dots or backticks
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = [StructField(f"c{i}", StringType() if i == at else f.dataType) for i, f in enumerate(docs.schema.fields)]
    return plain.mapInArrow(run, StructType(fields)).toDF(*docs.columns)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op1_pii_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    text = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.transform(F.filter("spans", lambda s: s["kind"].isin(*BASE)),
                       lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    counts = [F.size(F.filter("spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(text, ",").alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))
