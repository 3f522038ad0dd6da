"""Training, scoring, save/load."""

import math

import numpy as np
from pyspark.sql import functions as F

from mailspark.config import VectorizerConfig
from mailspark.operators.model import doc_vectors, fit_logistic, load_model, save_model, with_y
from mailspark.operators.terms import doc_term_counts
from mailspark.operators.vocab import fit_vocabulary
from mailspark.plans.train import fit_text_model, score_docs
from mailspark.session import scratch_table_path
from mailspark.sources.tables import labelled_docs

SF = "/root/testdata/sf0.001"


def test_zero_vector_scores_intercept(spark):
    docs = labelled_docs(spark, SF)
    m = fit_text_model(docs, VectorizerConfig(words_to_keep=50), ridge=1.0, max_iter=50)
    extra = spark.createDataFrame([(-1, "", "ham"), (-2, "qqqqzzz 123", "spam")], "doc_id BIGINT, text STRING, label STRING")
    s = {r["doc_id"]: r for r in score_docs(extra, m).collect()}
    p0 = 1 / (1 + math.exp(-m.intercept))
    for i in (-1, -2):
        assert math.isclose(s[i]["probability"], p0, rel_tol=1e-9)
        assert s[i]["prediction"] == ("spam" if p0 > 0.5 else "ham")


def test_vectors_need_no_python(spark):
    docs = labelled_docs(spark, SF)
    cfg = VectorizerConfig(words_to_keep=50)
    counts = doc_term_counts(docs, cfg, outer=True)
    vocab = fit_vocabulary(counts.filter(F.col("term").isNotNull()), docs.count(), cfg)
    empty = spark.createDataFrame([(-1, "ham", None, None)], counts.select("doc_id", "label", "term", "f").schema)
    vectors = doc_vectors(counts.select("doc_id", "label", "term", "f").unionByName(empty), vocab)
    assert "Python" not in vectors._jdf.queryExecution().toString()
    got = {r["doc_id"]: r["features"] for r in vectors.collect()}
    assert got[-1].size == vocab.size and got[-1].numNonzeros() == 0
    assert all((np.diff(v.indices) > 0).all() for v in got.values())


def test_scoring_equals_spark_ml_and_save_load(spark):
    docs = labelled_docs(spark, SF)
    cfg = VectorizerConfig(words_to_keep=100)
    counts = doc_term_counts(docs, cfg, outer=True).cache()
    n = docs.count()
    vocab = fit_vocabulary(counts.filter(F.col("term").isNotNull()), n, cfg)
    vec = with_y(doc_vectors(counts, vocab)).cache()
    assert vec.count() == n  # no document lost (F5)
    lr = fit_logistic(vec, 1.0, n, max_iter=100)
    ml = {r["doc_id"]: float(r["probability"][1]) for r in lr.transform(vec).collect()}
    m = fit_text_model(docs, cfg, ridge=1.0, max_iter=100)
    ours = {r["doc_id"]: r["probability"] for r in score_docs(docs, m).collect()}
    assert set(ours) == set(ml)
    for k in ml:
        assert math.isclose(ours[k], ml[k], abs_tol=1e-6)
    path = scratch_table_path(spark, "model")
    save_model(m, path)
    m2 = load_model(spark, path)
    again = {r["doc_id"]: r["probability"] for r in score_docs(docs, m2).collect()}
    for k in ours:
        assert math.isclose(ours[k], again[k], abs_tol=1e-12)


def test_penalty_mapping_and_shrinkage(spark):
    """Gradient of ``sum(logloss) + ridge * |beta_std|^2`` is ~0 at the fit;
    more ridge gives smaller coefficients."""
    docs = labelled_docs(spark, SF)
    cfg = VectorizerConfig(words_to_keep=30, weighting="TF")
    counts = doc_term_counts(docs, cfg, outer=True).cache()
    n = docs.count()
    vocab = fit_vocabulary(counts.filter(F.col("term").isNotNull()), n, cfg)
    vec = with_y(doc_vectors(counts, vocab)).cache()
    rows = vec.select("features", "y").collect()
    X = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["y"] for r in rows])
    sd = X.std(axis=0, ddof=1)
    norms = []
    for ridge in (1.0, 10.0):
        m = fit_logistic(vec, ridge, n, max_iter=500, tol=1e-10)
        b, b0 = m.coefficients.toArray(), m.intercept
        p = 1 / (1 + np.exp(-(X @ b + b0)))
        g = X.T @ (p - y) + 2 * ridge * b * sd**2 * np.where(sd > 0, 1, 0)
        assert np.max(np.abs(g[sd > 0])) < 1e-3
        assert abs(np.sum(p - y)) < 1e-3
        norms.append(np.linalg.norm(b * sd))
    assert norms[1] < norms[0]


def test_one_class_absent(spark):
    """Training data with ham only: Spark ML gives zero coefficients and an
    infinite intercept; every document scores ham, metrics stay defined
    where they can be."""
    from mailspark.operators.evaluate import quality_report

    docs = labelled_docs(spark, SF).filter(F.col("label") == "ham")
    m = fit_text_model(docs, VectorizerConfig(words_to_keep=20), 1.0, 20)
    pred = score_docs(docs, m)
    assert {r["prediction"] for r in pred.collect()} == {"ham"}
    rep = {(r["class"], r["metric"]): r["value"] for r in quality_report(pred).collect()}
    assert rep[(None, "accuracy")] == 100.0 and rep[("spam", "f")] is None
