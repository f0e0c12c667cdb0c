"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last returns tokens. A stage works on all that its
predecessor kept. Null and repeated rows are treated as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.bpe import encode, vocabulary_path
from hourgrid.llm.common import read
from hourgrid.llm.mixing import mixed_documents
from hourgrid.llm.pii import redact
from hourgrid.llm.quality import fit, keep_good
from hourgrid.llm.simhash import keep_one
from hourgrid.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return keep_good(docs, fit(docs, read(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    clean = redact(docs)
    if "n_chars" in clean.columns:
        kind = clean.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind))
    return clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it (0 to 3 times)."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every document taken."""
    return encode(docs, vocabulary_path(), columns=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: SimHash, checksums and BPE are beyond SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
