"""Licence scan by ordered signature rules, as DataFrame expressions.

A keyword prefilter picks, per text, the rules that can match at all: each keyword
is looked for once, and only patterns whose keyword occurs run. No pattern matches a
text without its keyword. The matches are intervals (code points) with the rule's priority.
An interval inside another one of equal or stronger priority is suppressed, so
"GNU General Public License, version 3" leaves gpl-3.0 and not also gpl.

Base phrases are places in the sequence of words; they are never suppressed.

Starts and suppression go over a text's intervals in blocks of ``STEP``: sums and
largest ends of whole blocks, then of the few before an interval in its block, so a
text of n notices takes about n * STEP steps, not n * n.

Defined results: a null or empty text has no words, no places, empty labels and
score 0; repeated rows and null ids are scanned like any other row; very long texts
are scanned whole; other columns, whatever their names, are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ascii_lower, read
from hourgrid.llm.license_rules import Rule, rules

# fixed values: words, base phrases and their labels
_CHARS = r"0-9A-Za-z\x{80}-\x{10FFFF}"
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
BASE_CONFIDENCE = 0.9
#: Intervals of a block.
STEP = 128


def _has_phrase() -> str:
    either = "|".join(f"[^{_CHARS}]+".join(p.split()) for p, _ in PHRASES)
    return f"(?i)(?<![{_CHARS}])(?:{either})(?![{_CHARS}])"


def _any(low: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def _places(words: Column) -> Column:
    """(at, label) of every place of a base phrase; no two phrases start with the same word."""

    def label(i):
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES:
            same = [F.get(words, i + k) == w for k, w in enumerate(phrase.split())]
            found = F.when(reduce(lambda a, b: a & b, same), F.lit(name)).otherwise(found)
        return found

    seen = F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.struct(i.cast("long").alias("at"), label(i).alias("label")))
    return F.filter(seen, lambda x: x["label"].isNotNull())


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _blocks(items: Column) -> Column:
    """An array cut into arrays of ``STEP`` items."""
    last = F.floor((F.size(items) - 1) / STEP).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * STEP + 1, F.lit(STEP)))
    return F.when(F.size(items) > 0, cut).otherwise(F.filter(F.array(items), lambda x: F.size(x) > 0))


def _starts(hits: Column, gaps: Column) -> Column:
    """Where each match starts: the lengths of all gaps and matches before it, and of the gap before it."""
    def within(block, before):
        return F.transform(block, lambda x, i: before + _sum(F.transform(F.slice(block, F.lit(1), i), lambda y: y["gap"] + y["hit"])) + x["gap"])

    pieces = F.transform(hits, lambda h, k: F.struct(F.length(F.get(gaps, k)).alias("gap"), F.length(h).alias("hit")))
    whole = lambda block: _sum(F.transform(block, lambda y: y["gap"] + y["hit"]))
    return _let(_blocks(pieces), lambda blocks: _let(F.transform(blocks, whole), lambda sums: F.flatten(
        F.transform(blocks, lambda block, b: within(block, _sum(F.slice(sums, F.lit(1), b)))))))


def _outermost(found: Column, levels: list[int]) -> Column:
    """Intervals that no other one of equal or stronger priority holds; of equal ones the first rule's.

    In order of start, longest first, an interval is held by one before it that ends at its end or later.
    """
    def ends(items, level):
        return F.coalesce(F.array_max(F.transform(F.filter(items, lambda e: e["priority"] <= level), lambda e: e["end"])), F.lit(-1))

    def tops(blocks):  # the largest end per block and priority, stronger ones included
        return F.transform(blocks, lambda block: F.array(*[ends(block, F.lit(p)) for p in levels]))

    def before(top, b, priority):  # the largest end in the blocks before b
        at = (F.array_position(F.array(*map(F.lit, levels)), priority) - 1).cast("int")
        return F.coalesce(F.array_max(F.transform(F.slice(top, F.lit(1), b), lambda t: F.get(t, at))), F.lit(-1))

    def alone(block, b, top):
        return F.filter(block, lambda d, i: F.greatest(before(top, b, d["priority"]), ends(F.slice(block, F.lit(1), i), d["priority"])) < d["end"])

    order = F.array_sort(F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("_back"), x["priority"].alias("priority"), x["rule"].alias("rule"),
        x["end"].alias("end"), x["label"].alias("label"), x["confidence"].alias("confidence"))))
    return _let(_blocks(order), lambda blocks: _let(tops(blocks), lambda top: F.flatten(F.transform(blocks, lambda block, b: alone(block, b, top)))))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, places (base), detections (start, end, label, confidence), labels, score."""
    signatures = signatures or rules()
    held: dict[str, list[Column]] = {}
    for i, r in enumerate(signatures):
        held.setdefault(r.keyword, []).append(F.struct(
            F.lit(r.priority).alias("priority"), F.lit(i).alias("rule"), F.lit(r.label).alias("label"),
            F.lit(r.pattern).alias("pattern"), F.lit(r.confidence).alias("confidence")))
    table = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*own).alias("rules")) for k, own in held.items()])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.lower(text).alias("low"))
    low = F.col("low")
    phrase_words = sorted({p.split()[-1] for p, _ in PHRASES} - {"by"}) + ["cc"]
    has_base = _any(low, phrase_words) & F.col("text").rlike(_has_phrase())
    chosen = F.flatten(F.transform(F.filter(table, lambda k: F.contains(low, k["keyword"])), lambda k: k["rules"]))
    df = df.select(
        "doc_id", "text", F.regexp_count("text", F.lit(f"[{_CHARS}]+")).cast("long").alias("n_words"),
        F.when(has_base, F.transform(F.regexp_extract_all("text", F.lit(f"[{_CHARS}]+"), F.lit(0)), ascii_lower)).alias("words"),
        chosen.alias("chosen"))
    # each rule's matches, and the pieces of the text between them, give its intervals
    found = F.transform("chosen", lambda r: F.struct(
        r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"), r["confidence"].alias("confidence"),
        r["pattern"].alias("pattern"), F.regexp_extract_all(F.col("text"), r["pattern"], F.lit(0)).alias("hits")))
    df = df.select("doc_id", "text", "n_words", F.coalesce(_places(F.col("words")), F.array().cast("array<struct<at:bigint,label:string>>")).alias("places"),
                   F.filter(found, lambda x: F.size(x["hits"]) > 0).alias("found"))
    cut = F.transform("found", lambda x: F.struct(x["priority"].alias("priority"), x["rule"].alias("rule"), x["label"].alias("label"),
                                                  x["confidence"].alias("confidence"), x["hits"].alias("hits"),
                                                  F.split(F.col("text"), x["pattern"], -1).alias("gaps")))
    df = df.select("doc_id", "n_words", "places", cut.alias("cut"))

    def intervals(x):
        return F.transform(F.arrays_zip(_starts(x["hits"], x["gaps"]).alias("start"), x["hits"].alias("hit")), lambda m: F.struct(
            m["start"].alias("start"), (m["start"] + F.length(m["hit"])).alias("end"), x["priority"].alias("priority"),
            x["rule"].alias("rule"), x["label"].alias("label"), x["confidence"].alias("confidence")))

    df = df.select("doc_id", "n_words", "places", F.flatten(F.transform("cut", intervals)).alias("all"))
    kept = _outermost(F.col("all"), sorted({r.priority for r in signatures}))
    df = df.select("doc_id", "n_words", "places", F.size(F.coalesce("all", F.array())).alias("_n"),
                   F.coalesce(kept, F.array().cast("array<struct<start:int,_back:int,priority:int,rule:int,end:int,label:string,confidence:double>>")).alias("kept"))
    names = F.concat(F.transform("places", lambda p: p["label"]), F.transform("kept", lambda d: d["label"]))
    best = F.array_max(F.transform("kept", lambda d: d["confidence"]))
    score = F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("places") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0)))
    detections = F.array_sort(F.transform("kept", lambda d: F.struct(d["start"], d["end"], d["label"], d["confidence"])))
    return df.select("doc_id", "n_words", "places", detections.alias("detections"), F.array_sort(F.array_distinct(names)).alias("labels"), score.alias("score"))


def op5_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(read(spark, sf_dir, "documents"))
    at = F.transform("places", lambda p: p["at"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
