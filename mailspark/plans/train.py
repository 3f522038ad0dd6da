"""Fit, hold-out quality and final training."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.config import MAX_ITER, PRESET_RIDGE, VectorizerConfig
from mailspark.operators.evaluate import quality_report
from mailspark.operators.model import TextModel, doc_vectors, fit_logistic, model_from_fit, score_counts, sized_partitions, with_y
from mailspark.operators.split import stratified_split
from mailspark.operators.terms import doc_term_counts
from mailspark.operators.vocab import fit_vocabulary


def fit_text_model(train_docs: DataFrame, cfg: VectorizerConfig, ridge: float = PRESET_RIDGE, max_iter: int = MAX_ITER) -> TextModel:
    """M2 fit: vocabulary on ``train_docs (doc_id, text, label)`` only,
    then ridge logistic regression on their sparse vectors."""
    counts = doc_term_counts(train_docs, cfg, keep=("doc_id", "label"), outer=True).persist(StorageLevel.MEMORY_AND_DISK)
    n = train_docs.count()
    vocab = fit_vocabulary(counts.filter(F.col("term").isNotNull()), n, cfg)
    vectors = with_y(doc_vectors(counts, vocab)).persist(StorageLevel.MEMORY_AND_DISK)
    vectors.count()
    lr = fit_logistic(vectors, ridge, n, max_iter, partitions=sized_partitions(vectors))
    model = model_from_fit(vocab, lr, ridge)
    vectors.unpersist()
    counts.unpersist()
    vocab.unpersist()
    return model


def score_docs(docs: DataFrame, model: TextModel, keep=("doc_id", "label"), text_col: str = "text") -> DataFrame:
    """M4 / M5: clean, tokenise and score any frame with a text column; the
    true label (if any) is only passed through (F4)."""
    keep = [c for c in keep if c in docs.columns]
    counts = doc_term_counts(docs, model.cfg, text_col=text_col, keep=keep, outer=True)
    return score_counts(counts, model.joinable().select("term", "idf", "coef"), model.intercept, model.cfg.weighting, keep=keep)


def holdout_quality(docs: DataFrame, cfg: VectorizerConfig, ridge: float = PRESET_RIDGE, max_iter: int = MAX_ITER) -> DataFrame:
    """M6 (3.2): stratified 80/20 split, fit on train, report on test."""
    parts = stratified_split(docs.select("doc_id", "text", "label"))  # a narrow tag: texts are not cached
    train = parts.filter(F.col("part") == "train").select("doc_id", "text", "label")
    test = parts.filter(F.col("part") == "test").select("doc_id", "text", "label")
    model = fit_text_model(train, cfg, ridge, max_iter)
    report = quality_report(score_docs(test, model))
    rows = docs.sparkSession.createDataFrame(report.collect(), report.schema)  # nine rows
    model.unpersist()
    return rows


def train_final(docs: DataFrame, cfg: VectorizerConfig, ridge: float = PRESET_RIDGE, max_iter: int = MAX_ITER) -> TextModel:
    """M3: refit on all labelled documents, no split."""
    return fit_text_model(docs.select("doc_id", "text", "label"), cfg, ridge, max_iter)
