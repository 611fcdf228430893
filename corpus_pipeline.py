"""Corpus pipeline: ordered stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns of their docs.  A stage works on all rows and whole texts that the one
before it kept; nulls, empty texts and repeated rows are handled as the
operators' modules state; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup, packing, quality, secret_scan, simhash, tokens
from ledgerline.llm.common import documents, stored

END_ID = 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the posterior reject go."""
    return quality.keep_good(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by fingerprints stays: the smallest doc_id."""
    return simhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; secrets in its text are replaced by their kind."""
    clean = secret_scan.redact(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length with their token ids."""
    return packing.packed(docs, tokens.tokenizer_path(tokens.WORD_BPE), END_ID)


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # fingerprints and token ids are beyond SQL; tests hold a plain form against it


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
