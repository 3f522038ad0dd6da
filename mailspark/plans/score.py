"""Batch scoring of mail folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailspark.operators.model import TextModel, load_model
from mailspark.plans.train import score_docs
from mailspark.sources.folders import read_mail_folder
from mailspark.sources.sinks import write_prediction_lines


def score_folders(spark: SparkSession, folders: list[str], model: TextModel) -> DataFrame:
    """``(doc_id, file_name, margin, probability, prediction)`` for every
    ``*.txt`` file of the folders. Folder names are not labels (F4)."""
    mails = None
    for f in folders:
        m = read_mail_folder(spark, f).select("doc_id", "file_name", "text")
        mails = m if mails is None else mails.unionByName(m)
    return score_docs(mails, model, keep=("doc_id", "file_name"))


def score_folders_to_lines(spark: SparkSession, folders: list[str], model_path: str, out_path: str) -> DataFrame:
    """S4 -> M4 -> S5: load the model tables, score, write the lines."""
    model = load_model(spark, model_path)
    pred = score_folders(spark, folders, model)
    write_prediction_lines(pred, out_path)
    return pred
