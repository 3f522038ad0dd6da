"""Tokens, counts, vocabulary with ties, weights (FIXTURES 5)."""

import math

from pyspark.sql import functions as F

from mailspark.config import VectorizerConfig
from mailspark.functions.tokens import bigrams, word_tokens
from mailspark.operators import terms as TM
from mailspark.operators import vocab as V

DOCS = [(1, "meeting at noon", "ham"), (2, "meeting notes", "ham"), (3, "free money free", "spam"), (4, "free offer", "spam")]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id BIGINT, text STRING, label STRING")


def fit(spark, k, kind="TF_IDF"):
    cfg = VectorizerConfig.for_kind(kind, words_to_keep=k)
    counts = TM.doc_term_counts(docs(spark), cfg)
    vocab = V.fit_vocabulary(counts, 4, cfg)
    w = {(r["doc_id"], r["term"]): r["weight"] for r in V.transform(counts, vocab).collect()}
    terms = {r["term"] for r in vocab.table.collect()}
    return terms, w, vocab


def test_tokens_apostrophe_and_bigrams(spark):
    df = spark.createDataFrame([("don't stop",), ("one",), ("",), ("free money free",)], "t STRING")
    rows = df.select(word_tokens("t").alias("w")).select("w", bigrams("w").alias("b")).collect()
    assert rows[0]["w"] == ["don", "t", "stop"]
    assert rows[1]["b"] == [] and rows[2]["b"] == [] and rows[2]["w"] == []
    assert rows[3]["b"] == ["free money", "money free"]


def test_counts(spark):
    c = TM.doc_term_counts(docs(spark), VectorizerConfig())
    got = {(r["doc_id"], r["term"]): r["f"] for r in c.collect()}
    assert got[(3, "free")] == 2 and got[(3, "money")] == 1 and len(got) == 9


def test_counts_outer_keeps_empty_doc(spark):
    d = spark.createDataFrame([(1, "", "ham"), (2, "a a b", "spam")], "doc_id BIGINT, text STRING, label STRING")
    c = TM.doc_term_counts(d, VectorizerConfig(), outer=True).collect()
    assert sorted((r["doc_id"], r["term"], r["f"]) for r in c if r["doc_id"] == 2) == [(2, "a", 2), (2, "b", 1)]
    assert [(r["term"], r["f"]) for r in c if r["doc_id"] == 1] == [(None, None)]


def test_topk_ties(spark):
    t1, w1, v1 = fit(spark, 1)
    assert t1 == {"meeting", "free"}
    assert math.isclose(w1[(1, "meeting")], 0.480453, abs_tol=1e-6)
    assert math.isclose(w1[(2, "meeting")], 0.480453, abs_tol=1e-6)
    assert math.isclose(w1[(3, "free")], 0.761500, abs_tol=1e-6)
    assert math.isclose(w1[(4, "free")], 0.480453, abs_tol=1e-6)
    t2, w2, v2 = fit(spark, 2)
    assert t2 == {"meeting", "at", "noon", "notes", "free", "money", "offer"}
    assert math.isclose(w2[(3, "money")], 0.960906, abs_tol=1e-6)
    idx = sorted(r["idx"] for r in v2.table.collect())
    assert idx == list(range(7))


def test_binary_and_tf(spark):
    _, wb, _ = fit(spark, 2, "BINARY")
    assert set(wb.values()) == {1.0}
    _, wt, _ = fit(spark, 2, "TF")
    assert math.isclose(wt[(3, "free")], math.log(3))


def test_test_blind(spark):
    """Changing test text never changes the fitted vocabulary."""
    cfg = VectorizerConfig(words_to_keep=1)
    train = docs(spark)
    v = V.fit_vocabulary(TM.doc_term_counts(train, cfg), 4, cfg)
    test = spark.createDataFrame([(9, "zebra zebra zebra meeting", "spam")], "doc_id BIGINT, text STRING, label STRING")
    out = V.transform(TM.doc_term_counts(test, cfg), v).collect()
    assert [r["term"] for r in out] == ["meeting"]
    assert math.isclose(out[0]["weight"], math.log(2) * math.log(2))


def test_stopwords_in_row(spark):
    cfg = VectorizerConfig(words_to_keep=10, stopwords=("at", "free"))
    c = TM.doc_term_counts(docs(spark), cfg)
    assert c.filter(F.col("term").isin("at", "free")).count() == 0
    assert c.filter(F.col("term") == "money").count() == 1
