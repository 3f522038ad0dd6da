"""The corpus pipeline: language ID, near-duplicates, repeated passages, secrets, packing.

Every stage works on all that its predecessor kept. ``run`` writes each stage's rows as Parquet under the shared scratch
folder and reads them again, so a stage starts from a table and not from a plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailspark.llm import langid, minhash, packing, passages, secret_scan
from mailspark.llm.common import Stages
from mailspark.llm.queries import PACK


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return minhash.drop_near_duplicates(docs, minhash.MinMax(shingle=5, percent=80))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages from texts."""
    return passages.without_repeats(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by a mark."""
    return secret_scan.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training windows."""
    return packing.pack(docs, PACK)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_redaction),
    ("packing", pack_windows),
]

#: SQL can't express a trained classifier, nor the packing; tests hold the whole chain against one in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    stages = Stages(spark, "pipeline")
    for _, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir))
    return docs
