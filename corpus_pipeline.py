"""Corpus pipeline: quality rules, near-duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of ``documents``; the last returns a row of digests for
each document that is left. ``run`` writes each stage's result as Parquet to the
shared scratch folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.llm import decontaminate, pii, quality_rules, simhash
from shelfmill.llm.queries import bpe_digests, table
from shelfmill.session import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's contamination rule does not name."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", token_stage),
]

# XXH64 fingerprints and byte-pair merges are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
