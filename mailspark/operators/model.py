"""Sparse vectors, ridge logistic regression, model tables and scoring
(SURVEY 2.7 V8, 2.8 M1-M5).

Training uses Spark ML's ``LogisticRegression``; the reference's penalty
``ridge * sum(beta^2)`` on standardised features with a free intercept is
Spark's objective ``mean(loss) + regParam/2 * |beta|^2`` with
``regParam = 2 * ridge / n``. Scoring needs no ML object: the model is a
term table joined to the documents' term counts, summed per document.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from mailspark.config import MAX_ITER, VectorizerConfig
from mailspark.functions.text import HAM, SPAM, decode_prediction, encode_label
from mailspark.operators.vocab import Vocabulary, weight_expr
from mailspark.session import create_file, small_files

TOL = 1e-8


def _sparse(size: int, indices, values):
    """A sparse vector without Python: a vector's fields, read back by Spark as its vector type (doubles survive the text
    form unchanged)."""
    fields = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]


def doc_vectors(counts_outer: DataFrame, vocab: Vocabulary, keep=("doc_id", "label")) -> DataFrame:
    """V8: ``keep + (features VECTOR)`` for every document of
    ``counts_outer`` (term counts produced with ``outer=True``, so documents
    without tokens have one NULL-term row). Terms outside the vocabulary
    and empty documents give zero entries, never a lost row (F5).

    One shuffle: the group-by on the document, after a map-side partial
    aggregate that already holds each document whole."""
    keep = [c for c in keep if c in counts_outer.columns]
    j = counts_outer.join(vocab.joinable(), "term", "left")
    w = weight_expr(vocab.cfg, F.col("f"), F.col("df"), F.col("n_train"))
    entry = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx").alias("i"), w.alias("v")))
    grouped = j.groupBy(*keep).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return grouped.select(*keep, _sparse(vocab.size, F.col("_e.i"), F.col("_e.v")).alias("features"))


def ridge_to_reg_param(ridge: float, n: int) -> float:
    return 2.0 * float(ridge) / max(int(n), 1)


def fit_logistic(vectors: DataFrame, ridge: float, n: int, max_iter: int = MAX_ITER, tol: float = TOL, partitions: int | None = None):
    """M1 on ``(features, y)``; ``n`` is the number of training rows. Every solver
    iteration is one distributed gradient pass over the partitions as they come
    (AQE sizes them by bytes); ``partitions`` narrows them where a caller knows
    that its training set is small."""
    if partitions:
        vectors = vectors.coalesce(partitions)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="y",
        regParam=ridge_to_reg_param(ridge, n),
        elasticNetParam=0.0,
        standardization=True,
        fitIntercept=True,
        maxIter=max_iter,
        tol=tol,
        family="binomial",
    )
    return lr.fit(vectors)


def sized_partitions(persisted: DataFrame, target: int = 64 << 20) -> int:
    """Partitions of about ``target`` bytes for a persisted and counted frame, by
    the bytes that it holds. A solver passes over its vectors once an
    iteration, so many small partitions cost a task each every time; this
    only lays rows out, the fitted model is the same."""
    held = persisted._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(1, -(-int(str(held)) // target))


def with_y(vectors: DataFrame, label_col: str = "label") -> DataFrame:
    return vectors.withColumn("y", encode_label(label_col).cast("double"))


@dataclass
class TextModel:
    """M2: fitted vectorizer + classifier as two tables.

    ``terms(term, idx, idf, coef)`` and scalar metadata; ``idf`` is
    ``ln(N/df)`` for TF-IDF and 1 otherwise."""

    terms: DataFrame
    intercept: float
    n_train: int
    ridge: float
    cfg: VectorizerConfig
    size: int

    def meta(self, spark: SparkSession) -> DataFrame:
        c = self.cfg
        return spark.createDataFrame(
            [
                (
                    float(self.intercept),
                    int(self.n_train),
                    float(self.ridge),
                    int(c.words_to_keep),
                    c.kind,
                    "|".join(c.stopwords) if c.stopwords else None,
                    c.stemmer_name,
                    bool(c.stop_before_stem),
                    int(self.size),
                )
            ],
            "intercept DOUBLE, n_train BIGINT, ridge DOUBLE, k INT, vectorizer STRING, stop_list STRING, stemmer STRING, stop_before_stem BOOLEAN, vocab_size BIGINT",
        )

    def joinable(self) -> DataFrame:
        return self.terms

    def unpersist(self) -> None:
        self.terms.unpersist()


def model_from_fit(vocab: Vocabulary, lr_model, ridge: float) -> TextModel:
    """Attach the fitted coefficients to the vocabulary table. The
    coefficient vector has vocabulary size (bounded by K per class plus
    ties) and enters the plan as a small table joined on ``idx``."""
    import numpy as np
    import pandas as pd

    spark = vocab.table.sparkSession
    coefs = lr_model.coefficients.toArray()
    pdf = pd.DataFrame({"idx": np.arange(coefs.size, dtype=np.int32), "coef": coefs.astype(np.float64)})
    coef_df = spark.createDataFrame(pdf, "idx INT, coef DOUBLE")
    cfg = vocab.cfg
    idf = F.lit(1.0) if cfg.weighting != "TF_IDF" else F.log(F.col("n_train").cast("double") / F.col("df").cast("double"))
    terms = (
        vocab.table.join(coef_df, "idx")
        .select("term", "idx", idf.alias("idf"), "coef")
        .cache()
    )
    terms.count()
    return TextModel(terms, float(lr_model.intercept), vocab.n_train, ridge, cfg, vocab.size)


def score_counts(counts_outer: DataFrame, model_terms: DataFrame, intercept: float | None, weighting: str, keep=("doc_id",)) -> DataFrame:
    """M4: ``keep + (margin, probability, prediction)`` from term counts.

    ``model_terms(term, idf, coef)`` is joined (broadcast when small) to
    the counts; contributions are summed per document with a map-side
    partial sum, so the shuffle carries one row per document. Documents
    without any model term score the intercept (F5). ``intercept`` may be
    None when ``model_terms`` carries an ``intercept`` column instead."""
    keep = [c for c in keep if c in counts_outer.columns]
    j = counts_outer.join(model_terms, "term", "left")
    w = F.lit(1.0) if weighting == "BINARY" else F.log1p(F.col("f").cast("double")) * F.col("idf")
    summed = j.groupBy(*keep).agg(F.sum(F.coalesce(w * F.col("coef"), F.lit(0.0))).alias("_s"))
    margin = F.col("_s") + F.lit(float(intercept))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return summed.select(
        *keep,
        margin.alias("margin"),
        p.alias("probability"),
        F.when(p > 0.5, F.lit(SPAM)).otherwise(F.lit(HAM)).alias("prediction"),
    )


def save_model(model: TextModel, path: str) -> int:
    """S3: a new version of the model under ``path``; returns its number.

    The two Parquet tables go to a folder of their own first. A small file
    named by the version then points to that folder; it is created only if no
    writer has taken the number yet, else the next one is tried. So readers
    see whole versions only, and no version has another one's intercept."""
    spark = model.terms.sparkSession
    folder = uuid.uuid4().hex
    model.terms.write.parquet(f"{path}/data/{folder}/model_terms")
    model.meta(spark).write.parquet(f"{path}/data/{folder}/model_meta")
    version = max(model_versions(spark, path), default=0) + 1
    while not create_file(spark, f"{path}/versions/{version:012d}", folder):
        version += 1
    return version


def model_versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Version numbers and the data folders that they point to."""
    return {int(name): folder for name, folder in small_files(spark, f"{path}/versions").items() if name.isdigit() and folder}


def load_model(spark: SparkSession, path: str, stemmer=None, version: int | None = None) -> TextModel:
    """Read the two tables of a version (the latest) back; the term table
    is cached. A model trained with a stemmer function needs the same function
    here."""
    versions = model_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no model in {path}")
    folder = f"{path}/data/{versions[max(versions) if version is None else version]}"
    meta = spark.read.parquet(f"{folder}/model_meta").first()
    terms = spark.read.parquet(f"{folder}/model_terms").cache()
    size = terms.count()
    stop = tuple(meta["stop_list"].split("|")) if meta["stop_list"] else None
    if meta["stemmer"] != "none" and stemmer is None:
        raise ValueError(f"model was trained with stemmer {meta['stemmer']!r}; pass it to load_model")
    cfg = VectorizerConfig.for_kind(
        meta["vectorizer"], words_to_keep=meta["k"], stemmer=stemmer or "none", stopwords=stop, stop_before_stem=meta["stop_before_stem"]
    )
    return TextModel(terms, meta["intercept"], meta["n_train"], meta["ridge"], cfg, size)


def gradient_at(counts_outer: DataFrame, model: TextModel, ridge: float) -> DataFrame:
    """``(term, gradient)``: the derivative of the ridge objective by each
    standardised coefficient, at the model's coefficients, and with a NULL
    term by the intercept. All are 0 at the optimum, and only there.

    ``counts_outer``: the training documents' ``(doc_id, label, term, f)``, one
    NULL-term row for a token-less document. Documents are scored, then each
    term sums residual times weight over its documents; sums are aggregated
    before the shuffle, and no vector is built."""
    cfg = model.cfg
    scored = score_counts(counts_outer, model.terms.select("term", "idf", "coef"), model.intercept, cfg.weighting, keep=("doc_id", "label"))
    residual = scored.select("doc_id", (F.col("probability") - encode_label("label")).alias("r"))
    n, total = residual.agg(F.count(F.lit(1)), F.sum("r")).first()
    w = F.lit(1.0) if cfg.weighting == "BINARY" else F.log1p(F.col("f").cast("double")) * F.col("idf")
    entries = counts_outer.join(model.terms.select("term", "idf", "coef"), "term").select("doc_id", "term", "coef", w.alias("w")).join(residual, "doc_id")
    sums = entries.groupBy("term", "coef").agg(F.sum(F.col("w") * F.col("r")).alias("wr"), F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    var = (F.col("q") - F.col("s") * F.col("s") / n) / max(n - 1, 1)
    sd = F.sqrt(F.when(var > 1e-14 * F.col("q"), var).otherwise(0.0))
    # a term of no variance has no coefficient
    slope = (F.col("wr") - total * F.col("s") / n) / sd / n + 2.0 * ridge / n * F.col("coef") * sd
    free = residual.sparkSession.createDataFrame([(None, float(total) / n)], "term STRING, gradient DOUBLE")
    return sums.select("term", F.when(sd > 0, slope).otherwise(F.col("coef")).alias("gradient")).unionByName(free)


__all__ = [
    "doc_vectors",
    "fit_logistic",
    "with_y",
    "TextModel",
    "model_from_fit",
    "score_counts",
    "save_model",
    "load_model",
    "model_versions",
    "gradient_at",
    "decode_prediction",
]
