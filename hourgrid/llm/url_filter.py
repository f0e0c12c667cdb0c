"""URL filter: explicit host/path rules, else an empirical-Bayes host reputation.

Labelled pages give each host good/all counts. Rates are shrunk by beta-binomial
priors along suffix -> registered domain -> host: the posterior mean of the level
above is the prior mean, and the prior strength comes from the spread of the
labelled rates below it (method of moments, between ``MIN_STRENGTH`` and
``MAX_STRENGTH``). A page is blocked when even the upper posterior bound of its
host's good rate is under ``threshold``; hosts with few labels stay near their
domain and are allowed.

Reputations belong to sites: hosts without user names and ports. A site that is an IP
address has no domain above it. Suffixes follow a rule, not a list: the last label, or
the last two where a country's two letters follow one of ``SECOND``. The bound is the
normal approximation of the posterior; with a prior of at least ``MIN_STRENGTH`` labels
it is wide where labels are few, and such sites are allowed.

Defined results: a null url, or one without ``://``, has empty host and path, no
rule, and is judged by the reputation of the empty host; null labels count as
no label; several labels of a page are one outcome (good only if all are good);
without any label every page without a rule is allowed; very long urls, repeated rows
and null ids are judged like others; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ascii_lower, attach, hot_keys, quoted, read
from hourgrid.session import materialize

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Second labels under which domains are registered where the last label is a country's two letters ("co.uk", "com.br").
SECOND = ("ac", "co", "com", "edu", "go", "gob", "gov", "govt", "gr", "mil", "ne", "net", "nom", "or", "org", "sch")
MIN_STRENGTH, MAX_STRENGTH = 2.0, 200.0
THRESHOLD, Z = 0.6, 1.645


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host that a reputation belongs to: without user names and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def _whole(site: Column) -> Column:
    """IP addresses have no registered domain above them."""
    return site.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$")


def _two_part(site: Column) -> Column:
    return F.substring_index(site, ".", -2).rlike(rf"^({'|'.join(SECOND)})\.[a-z][a-z]$")


def suffix_of(site: Column) -> Column:
    two = F.substring_index(site, ".", -2)
    return F.when(_whole(site), site).when(_two_part(site) & (two != site), two).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column) -> Column:
    two, three = (F.substring_index(site, ".", -n) for n in (2, 3))
    return F.when(_whole(site), site).when(_two_part(site), three).otherwise(two)


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule as text (host and path) and its verdict; else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _moments(children: DataFrame, level: str) -> DataFrame:
    """Prior strength per ``level`` from its children's (g, n): between-child spread of rates."""
    p = F.col("g") / F.col("n")
    sums = children.groupBy(level).agg(
        F.sum("g").alias("G"), F.sum("n").alias("N"), F.count(F.lit(1)).alias("c"),
        F.sum(F.col("n") * p * p).alias("s2"), F.sum(F.col("n") * F.col("n")).alias("n2"))
    mean = F.col("G") / F.col("N")
    spread = F.col("s2") - F.col("N") * mean * mean
    room = F.col("N") - F.col("n2") / F.col("N")
    between = F.try_divide(spread - (F.col("c") - 1) * mean * (1 - mean), room)
    raw = F.try_divide(mean * (1 - mean), between) - 1
    strength = F.when((F.col("c") > 1) & (room > 0) & (between > 0),
                      F.least(F.greatest(raw, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH))).otherwise(F.lit(MAX_STRENGTH))
    return sums.select(level, "G", "N", strength.alias("m"))


def reputation(pages: DataFrame, outcomes: DataFrame, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """Per host with a label, domain or suffix prior: the posterior and whether it is blocked.

    ``pages`` has (page_id, host); ``outcomes`` has (page_id, good in 0/1), one row per page.
    """
    counts = (pages.join(outcomes, "page_id").groupBy("host")
              .agg(F.sum("good").cast("double").alias("g"), F.count(F.lit(1)).cast("double").alias("n")))
    every = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    hosts = every.join(counts, "host", "left").select(
        "host", "n_pages", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "g", "n")
    hosts = materialize(hosts, "host-outcomes")
    labelled = hosts.where("n > 0")
    domains = labelled.groupBy("domain", "suffix").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    world = _moments(suffixes.withColumn("all", F.lit(0)), "all").first()
    if world is None:  # no label at all: nothing to learn from
        return hosts.select("host", "n_pages", F.lit(None).cast("double").alias("mean"), F.lit(1.0).alias("upper"), F.lit(False).alias("blocked"))
    mean0 = F.lit(world["G"] / world["N"])
    # suffix: shrunk to the mean of all; domain: to its suffix; host: to its domain
    top = (hosts.select("suffix").distinct().join(_moments(domains, "suffix"), "suffix", "left")
           .select("suffix", F.coalesce((F.col("G") + world["m"] * mean0) / (F.col("N") + world["m"]), mean0).alias("mu_s"),
                   F.coalesce("m", F.lit(MAX_STRENGTH)).alias("m_s")))
    mid = (hosts.select("domain", "suffix").distinct().join(_moments(labelled, "domain"), "domain", "left").join(top, "suffix")
           .select("domain", F.coalesce((F.col("G") + F.col("m_s") * F.col("mu_s")) / (F.col("N") + F.col("m_s")), "mu_s").alias("mu_d"),
                   F.coalesce("m", F.col("m_s")).alias("m_d")))
    a = F.coalesce("g", F.lit(0.0)) + F.col("m_d") * F.col("mu_d")
    b = F.coalesce("n", F.lit(0.0)) - F.coalesce("g", F.lit(0.0)) + F.col("m_d") * (1 - F.col("mu_d"))
    mean = a / (a + b)
    upper = mean + z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    return hosts.join(mid, "domain").select("host", "n_pages", mean.alias("mean"), upper.alias("upper"), (upper < threshold).alias("blocked"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
               threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, reputation (mean; null: no label anywhere)."""
    url = F.col(quoted(url_col))
    rows = pages.select(F.col(quoted(id_col)).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn("site", site_of(F.col("host")))
    ranks = reputation(rows.select("page_id", F.col("site").alias("host")), outcomes, threshold, z).withColumnRenamed("host", "site")
    ranks = materialize(ranks, "host-reputation")
    judged = attach(rows, ranks, ["site"], hot_keys(ranks, ["site"], "n_pages"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                         F.col("mean").alias("reputation"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes by page: good when every label says quality 1 and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id"))
            .agg(F.min(good.cast("int")).alias("good")))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read(spark, sf_dir, "pages"), page_outcomes(read(spark, sf_dir, "labels")))
    return judged.withColumn("reputation", F.round("reputation", 6))
