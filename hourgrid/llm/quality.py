"""Quality rules: statistics of whole texts and a learned decision list over them.

The list is learned by sequential covering on labelled statistics: a rule is grown
by adding the threshold that gains most (FOIL) on two thirds of the labelled rows,
pruned from its end on the other third, and accepted if it is precise there; the
rows it covers are taken out and the next rule is learned. The result is an ordered
list of threshold conjunctions, applied as one Spark conditional expression.

At most ``FIT_ROWS`` labelled rows, chosen by a hash of their id, are used to learn.
The statistics, and the verdicts, are DataFrame expressions over all rows.

Defined results: a null text has no words and fails the base rules; a row whose id
is null can't be labelled and is judged like any other; an id with several labels
is junk if all of them say so; repeated rows get the same verdict; without labels,
or when no rule is precise enough, only the base rules reject.
Repeated 3-word windows are found by equal 64-bit hashes within a text.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import WORD, quoted, read

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
FIT_ROWS, MAX_RULES, MAX_TERMS, CUTS = 5_000, 12, 3, 24
#: A rule must hold for this share of the labelled rows it covers, and cover so many, when pruned.
PRECISION, SUPPORT = 0.97, 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What rules are learned on: shares, so that a threshold means the same for any length.
FEATURES = ("symbols", "word_length", "dup_lines", "repeats", "upper", "exclaims", "digits", "distinct")

Rule = tuple[tuple[str, str, float], ...]


def _left(text: Column, dropped: str) -> Column:
    return F.length(F.regexp_replace(text, dropped, "")).cast("long")


def with_statistics(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of the base counts and the shares in FEATURES."""
    p = "_q"
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    own = [quoted(c) for c in docs.columns]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.select("*", text.alias(f"{p}text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias(f"{p}words"))
    t, w = F.col(f"{p}text"), F.col(f"{p}words")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(*own, t, F.size(w).cast("long").alias(f"{p}n"), F.transform(w, lambda x: F.xxhash64(x)).alias(f"{p}hash"), lines.alias(f"{p}lines"))
    n, wh, ln = F.col(f"{p}n"), F.col(f"{p}hash"), F.col(f"{p}lines")
    windows = F.transform(F.sequence(F.lit(0), (n - 3).cast("int")),
                          lambda i: F.xxhash64(F.get(wh, i), F.get(wh, i + 1), F.get(wh, i + 2)))
    chars = F.length(t).cast("long")
    df = df.select(
        *own, n, F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias(f"{p}win"),
        F.size(ln).alias(f"{p}n_lines"), F.size(F.array_distinct(ln)).alias(f"{p}d_lines"),
        F.size(F.array_distinct(wh)).alias(f"{p}d_words"),
        _left(t, r"[\x20\x09-\x0D]+").alias(f"{p}chars"), (chars - _left(t, "[#*$%&|<>]+")).alias(f"{p}symbols"),
        _left(t, r"[^\p{Lu}]+").alias(f"{p}upper"), _left(t, "[^!]+").alias(f"{p}excl"), _left(t, "[^0-9]+").alias(f"{p}digits"))
    win = F.col(f"{p}win")
    rest = [F.col(f"{p}{c}") for c in ("n", "n_lines", "d_lines", "d_words", "chars", "symbols", "upper", "excl", "digits")]
    # only texts with a repeated window sort theirs
    marked = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*own, *rest, F.when(F.size(F.array_distinct(win)) < F.size(win), marked).alias(f"{p}sorted"))
    s = F.col(f"{p}sorted")
    again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
    df = df.select(*own, *rest, F.sort_array(F.transform(again, lambda x: x["i"])).alias(f"{p}at"))
    at = F.col(f"{p}at")
    steps = F.transform(at, lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(at, k - 1))))
    repeated = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    df = df.select(*own, *rest, repeated.alias(f"{p}rep"))
    c = {x: F.col(f"{p}{x}") for x in ("n", "n_lines", "d_lines", "d_words", "chars", "symbols", "upper", "excl", "digits", "rep")}
    per_word, per_char = F.greatest(c["n"], F.lit(1)).cast("double"), F.greatest(c["chars"], F.lit(1)).cast("double")
    shares = {
        "symbols": c["symbols"] / per_word, "word_length": c["chars"] / per_word,
        "dup_lines": (c["n_lines"] - c["d_lines"]) / F.greatest(c["n_lines"], F.lit(1)).cast("double"),
        "repeats": c["rep"] / per_word, "upper": c["upper"] / per_char, "exclaims": c["excl"] / per_word,
        "digits": c["digits"] / per_char, "distinct": c["d_words"] / per_word,
    }
    counts = [c["n"].alias("n_words"), c["chars"].alias("word_chars"), c["symbols"].alias("n_symbols"),
              (c["n_lines"] - c["d_lines"]).cast("long").alias("n_dup_lines"), c["rep"].alias("n_repeat_words")]
    stats = F.struct(*counts, *[shares[k].alias(k) for k in FEATURES])
    # generated, not projected: a filter on the statistics must not be pushed below the
    # steps above, where it would compute all of them again inside one expression
    return df.select(*own, F.explode(F.array(stats)).alias(out))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PCT * stats["n_words"])


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for name, sign, cut in rule:
        v = x[:, FEATURES.index(name)]
        hit &= (v > cut) if sign == ">" else (v <= cut)
    return hit


def _cuts(v: np.ndarray, junk: np.ndarray) -> np.ndarray:
    """Midpoints at quantiles of the junk values and of all values."""
    values = np.unique(np.concatenate([np.quantile(x, np.linspace(0, 1, CUTS)) for x in (v, v[junk]) if len(x)]))
    return (values[1:] + values[:-1]) / 2


def _grow(x: np.ndarray, junk: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_TERMS and (inside & ~junk).any():
        p0, n0 = (inside & junk).sum(), (inside & ~junk).sum()
        best, best_gain = None, 1e-9
        for k, name in enumerate(FEATURES):
            v = x[:, k]
            for cut in _cuts(v[inside], junk[inside]):
                for sign, hit in ((">", v > cut), ("<=", v <= cut)):
                    hit = hit & inside
                    p, n = (hit & junk).sum(), (hit & ~junk).sum()
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0
                    if gain > best_gain:
                        best, best_gain = ((name, sign, float(cut)), hit), gain
        if best is None:
            break
        rule, inside = (*rule, best[0]), best[1]
    return rule


def learn_rules(x: np.ndarray, junk: np.ndarray) -> list[Rule]:
    """The decision list of junk rules for rows of FEATURES; deterministic in the order of the rows."""
    grow = np.arange(len(x)) % 3 != 0
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < MAX_RULES and (left & grow & junk).sum() >= SUPPORT:
        rule = _grow(x[left & grow], junk[left & grow])
        check = left & ~grow
        best = None
        for k in range(len(rule), 0, -1):
            hit = _covers(rule[:k], x) & check
            p, n = (hit & junk).sum(), (hit & ~junk).sum()
            worth = (p - n) / max(1, p + n)
            if best is None or worth > best[0]:
                best = (worth, rule[:k])
        if best is None:
            break
        hit = _covers(best[1], x) & left
        p, n = (hit & junk).sum(), (hit & ~junk).sum()
        if p < SUPPORT or p < PRECISION * (p + n) or best[0] < 2 * PRECISION - 1:
            break
        rules.append(best[1])
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> list[Rule]:
    """Learn the list from ``labels`` (doc_id, quality) of at most ``rows`` documents."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg((F.max("quality") == 0).alias("_junk")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` rows of two columns: bounded, whatever the size of the labels
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sample = with_statistics(named.join(F.broadcast(chosen), "doc_id"), "text", "_stats")
    sample = sample.where(~base_failed(F.col("_stats"))).groupBy("doc_id").agg(
        F.first("_junk").alias("junk"), *[F.min(F.col("_stats")[k]).alias(k) for k in FEATURES])
    got = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    if not got:
        return []
    return learn_rules(np.array([[r[k] for k in FEATURES] for r in got], dtype=float), np.array([r["junk"] for r in got], dtype=bool))


def rejects(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that holds (from 1), 0 if none does."""
    verdict = None
    for k, rule in enumerate(rules, 1):
        terms = [stats[name] > cut if sign == ">" else stats[name] <= cut for name, sign, cut in rule]
        both = reduce(lambda a, b: a & b, terms)
        verdict = F.when(both, k) if verdict is None else verdict.when(both, k)
    return F.lit(0) if verdict is None else verdict.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, kept, rule (number of the rule that rejects, else 0)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    judged = with_statistics(rows, "text", "stats").select("doc_id", "stats", base_failed(F.col("stats")).alias("base_failed"),
                                                            rejects(rules, F.col("stats")).alias("rule"))
    return judged.select("doc_id", *[F.col("stats")[c].alias(c) for c in BASE], "base_failed",
                         (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the base rules or the list reject."""
    out = "_stats"
    while out in docs.columns:
        out += "_"
    s = F.col(out)
    return with_statistics(docs, text_col, out).where(~base_failed(s) & (rejects(rules, s) == 0)).drop(out)


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, fit(docs, read(spark, sf_dir, "labels")))
