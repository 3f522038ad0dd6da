"""Mail folders as a DataFrame source.

One ``*.txt`` file is one row, read by the ``mails`` format: the folder is
listed once, tasks read slices of the listing, and zero-length files are mails
with empty text. Names starting with ``_`` or ``.`` are left out (a deliberate
difference), sub-folders are not read. A missing folder gives zero rows, not an
error. Text is read as UTF-8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.functions.text import HAM, SPAM, parse_sender, parse_sent_date
from mailspark.sources.mail_format import register


def read_mail_folder(spark: SparkSession, path: str, label: str | None = None) -> DataFrame:
    """``(doc_id, file_name, text, label, sender, sent_date)``;
    ``doc_id`` is the full file path (unique across folders)."""
    register(spark)
    return spark.read.format("mails").load(path).select(
        "doc_id",
        "file_name",
        "text",
        F.lit(label).cast("string").alias("label"),
        parse_sender("file_name").alias("sender"),
        parse_sent_date("file_name").alias("sent_date"),
    )


def write_mail_folder(mails: DataFrame, path: str) -> None:
    """The inverse: each row of ``(file_name, text)`` as a file of ``path``.
    Files of other names stay."""
    register(mails.sparkSession)
    mails.select("file_name", "text").write.format("mails").mode("append").save(path)


def read_labelled_folders(spark: SparkSession, ham_dir: str, spam_dir: str) -> DataFrame:
    """Ham folder then spam folder, unioned by name."""
    return read_mail_folder(spark, ham_dir, HAM).unionByName(read_mail_folder(spark, spam_dir, SPAM))
