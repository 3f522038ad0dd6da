"""Driver tables as labelled documents.

``documents`` JOIN ``labels``: ``toxic = 1`` is spam, ``toxic = 0`` ham (or
``quality`` for the second labelling). Only ``doc_id`` and ``text`` are read
from ``documents``, so the Parquet scan prunes the other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.functions.text import HAM, SPAM


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_CONF = "spark.mailspark.spreadSmallScans"


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` as it is, unless the session sets ``spark.mailspark.spreadSmallScans``
    to true: then hash-partitioned on ``key``, for a local run over one large
    Parquet row group that a single core would read. Never set on a cluster."""
    on = df.sparkSession.conf.get(SPREAD_CONF, "false") == "true"
    return df.repartition(key) if on else df


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The ``documents`` table with only ``cols`` read."""
    return spread(table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "text"))), "doc_id")


def labelled_docs(spark: SparkSession, sf_dir: str, label_col: str = "toxic") -> DataFrame:
    """``(doc_id BIGINT, text STRING, label STRING)`` for every labelled doc."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col(label_col) == 1, F.lit(SPAM)).otherwise(F.lit(HAM)).alias("label")
    )
    return docs.join(labels, "doc_id")


def labelled_docs_sql(label_col: str = "toxic") -> str:
    """The same input as SQL, for the DuckDB oracle."""
    return (
        "SELECT d.doc_id, d.text, CASE WHEN l.%s = 1 THEN 'spam' ELSE 'ham' END AS label "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id" % label_col
    )
