"""Pipeline over ``documents``: quality, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes each result as Parquet in the shared folder and reads it back as the
next stage's documents.  All stages but the last return the columns of
``documents``.  Null text counts as empty in every decision and stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import dedup, packing, quality, secrets
from lodestar.llm.common import read, shared_table

#: No SQL: a fitted classifier and a best-fit packer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return dedup.drop_near_duplicates(docs, width=5, percent=80)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the text; every document stays."""
    return secrets.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece of a document."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_dedup),
    ("secret scan", secret_redaction),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
