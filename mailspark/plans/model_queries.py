"""Queries that hold the model half against SQL: pooled out-of-fold scoring
(M7) and the winner (W5) with fixture coefficients, the optimality of a fit
(M1, M3), the model store (S3, S4), mail folders (S1) and the stream's
recovery (ST1)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.config import N_FOLDS, PRESET_RIDGE, WORDS_TO_KEEP, VectorizerConfig, tfidf_preset
from mailspark.functions import text as T
from mailspark.operators import model as M
from mailspark.operators import split as S
from mailspark.operators import terms as TM
from mailspark.operators import vocab as V
from mailspark.plans import sql_text as Q
from mailspark.session import scratch_table_path
from mailspark.sources.tables import table

#: A gradient below this (per document, standardised) counts as 0; at the start of a fit its entries are some 0.01 to 0.3.
GRADIENT_ZERO = 1e-4
CV_INTERCEPT = -1.0


def hold_models(stats: DataFrame, sizes: dict[int, int], k_max: int, n_folds: int) -> DataFrame:
    """``(hold, term, rk, idf, coef)``: a fixture model for every hold, from one
    aggregation of ``(fold, label, term, c, d)``: TF-IDF weights of the hold's
    documents and the coefficient ln((c_spam + 1) / (c_ham + 1))."""
    by_class = V.hold_stats(stats, n_folds).filter(F.col("hold") < n_folds)
    c = lambda label: F.coalesce(F.sum(F.when(F.col("label") == label, F.col("c"))), F.lit(0))
    coef = F.round(F.log((c(T.SPAM) + F.lit(1.0)) / (c(T.HAM) + F.lit(1.0))), 6)
    coefs = by_class.groupBy("hold", "term").agg(coef.alias("coef"))
    ranks = V.fold_term_ranks(stats, k_max, n_folds).filter(F.col("hold") < n_folds)
    n = F.element_at(F.array(*[F.lit(sum(sizes.values()) - sizes.get(i, 0)) for i in range(n_folds)]), F.col("hold") + 1)
    # broadcast: as bounded as the models
    return coefs.join(F.broadcast(ranks), ["hold", "term"]).select("hold", "term", "rk", F.log(n.cast("double") / F.col("df").cast("double")).alias("idf"), "coef")


def out_of_fold_margins(counts_outer: DataFrame, models: DataFrame, ks, intercept: float) -> DataFrame:
    """``(doc_id, label, m<k> ...)``: every document scored by the model that
    has not seen its fold, for several K at once: counts meet the models of
    all holds in one join on (fold, term), and a term counts towards each K
    that holds it. Documents without a model term keep the intercept."""
    # broadcast: at most K terms per hold and class, plus ties; counts never move by term
    joined = counts_outer.join(F.broadcast(models.withColumnRenamed("hold", "fold")), ["fold", "term"], "left")
    part = F.log1p(F.col("f").cast("double")) * F.col("idf") * F.col("coef")
    sums = [(F.coalesce(F.sum(F.when(F.col("rk") <= k, part)), F.lit(0.0)) + F.lit(intercept)).alias(f"m{k}") for k in ks]
    return joined.groupBy("doc_id", "label").agg(*sums)


def _pooled(spark: SparkSession, docs: DataFrame) -> DataFrame:
    train = S.stratified_split(docs).filter(F.col("part") == "train").select("doc_id", "text", "label")
    folded = train.join(S.train_folds(train, N_FOLDS), "doc_id")
    counts = TM.doc_term_counts(folded, VectorizerConfig(), keep=("doc_id", "label", "fold"), outer=True)
    stats = counts.filter(F.col("term").isNotNull()).groupBy("fold", "label", "term").agg(F.sum("f").alias("c"), F.count(F.lit(1)).alias("d")).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    models = hold_models(stats, sizes, max(WORDS_TO_KEEP), N_FOLDS).persist(StorageLevel.MEMORY_AND_DISK)
    models.count()
    stats.unpersist()
    margins = out_of_fold_margins(counts, models, WORDS_TO_KEEP, CV_INTERCEPT)
    says = F.array(*[F.struct(F.lit(k).alias("k"), (F.col(f"m{k}") > 0).alias("spam")) for k in WORDS_TO_KEEP])
    rows = margins.select((F.col("label") == T.SPAM).alias("true"), F.inline(says))
    n = lambda c: F.count(F.when(c, 1))
    cells = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"),
        n(F.col("true") & F.col("spam")).alias("hit"),
        n(F.col("spam")).alias("said"),
        n(F.col("true")).alias("spam_docs"),
    )
    f = F.when(F.col("hit") > 0, 2.0 * F.col("hit") / (F.col("said") + F.col("spam_docs")))
    return cells.select("k", "n", "hit", "said", "spam_docs", F.round(f, 6).alias("f_spam"))


def q_cv_pooled_fixture(spark, sf, docs):
    """M7: pooled 10-fold confusion and F for every K, fixture coefficients."""
    return _pooled(spark, docs(spark, sf))


def q_best_config_fixture(spark, sf, docs):
    """The winner among these points."""
    from mailspark.plans.tune import best_config

    points = _pooled(spark, docs(spark, sf)).select(F.lit("TF_IDF").alias("vectorizer"), F.lit(2).alias("vec_ord"), "k", F.lit(1.0).alias("ridge"), "f_spam")
    return best_config(points).select("vectorizer", "k", "f_spam")


def q_fit_optimality(spark, sf, docs):
    """M1 / M3: the preset's fit on all labelled documents, one row per term of
    its vocabulary and one for the intercept: is the objective's derivative 0?"""
    from mailspark.plans.train import train_final

    labelled = docs(spark, sf)
    model = train_final(labelled, tfidf_preset(), ridge=PRESET_RIDGE)
    counts = TM.doc_term_counts(labelled, model.cfg, keep=("doc_id", "label"), outer=True)
    return M.gradient_at(counts, model, PRESET_RIDGE).select("term", (F.abs("gradient") <= GRADIENT_ZERO).alias("optimal"))


def q_score_saved_model(spark, sf, fixture, documents):
    """The fixture model saved, loaded again and applied to all documents."""
    from mailspark.plans.train import score_docs

    terms, intercept, cfg = fixture(spark, sf)
    path = scratch_table_path(spark, "model-store")
    size = terms.count()
    M.save_model(M.TextModel(terms.withColumn("idx", F.lit(0)), intercept, 0, 0.0, cfg, size), path)
    scored = score_docs(documents, M.load_model(spark, path), keep=("doc_id",))
    return scored.select("doc_id", F.round("margin", 6).alias("margin"), F.round("probability", 6).alias("probability"), "prediction")


def mails_of(spark: SparkSession, sf: str, name) -> DataFrame:
    """Every document as a mail: its name, and its text with a non-ASCII end;
    French ones of an odd number of characters become empty mails."""
    empty = (F.col("lang") == "fr") & (F.col("n_chars") % 2 == 1)
    text = F.when(empty, F.lit("")).otherwise(F.concat("text", F.lit(" ñandú 漢字")))
    return table(spark, sf, "documents").select(name.alias("file_name"), text.alias("text"), "lang")


MAILS_SQL = (
    "m AS (SELECT {name} AS file_name, CASE WHEN lang = 'fr' AND n_chars % 2 = 1 THEN '' "
    "ELSE text || ' ñandú 漢字' END AS text FROM documents)"
)


def q_mail_folder(spark, sf, name):
    """S1, S1a, S1d: all documents written as mail files, the folder read back."""
    from mailspark.sources.folders import read_mail_folder, write_mail_folder

    path = scratch_table_path(spark, "mail-folder")
    write_mail_folder(mails_of(spark, sf, name), path)
    mails = read_mail_folder(spark, path)
    return mails.select("file_name", "sender", "sent_date", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"), T.clean_text("text").alias("clean"))


def q_score_stream_recovered(spark, sf, name, fixture):
    """ST1: mails arrive in a folder, a scoring query takes them and stops;
    more arrive, and the query goes on from its checkpoint. The committed
    rows are those of one batch over all mails."""
    from mailspark.sources.folders import write_mail_folder
    from mailspark.streaming.score_stream import mail_folder_stream, read_scores, start_scoring

    terms, intercept, cfg = fixture(spark, sf)
    model = M.TextModel(terms, intercept, 0, 0.0, cfg, 0)
    root = scratch_table_path(spark, "mail-stream")
    mails = mails_of(spark, sf, name)
    for arrived in (mails.where("lang in ('en', 'fr')"), mails.where("lang is null or lang not in ('en', 'fr')")):
        write_mail_folder(arrived, f"{root}/in")
        stream = mail_folder_stream(spark, f"{root}/in", f"{root}/files")
        q = start_scoring(stream, model, f"{root}/out", keep=("file_name",), checkpoint=f"{root}/checkpoint", available_now=True)
        q.awaitTermination()
    return read_scores(spark, f"{root}/out").select("file_name", F.round("margin", 6).alias("margin"), "prediction")


def cv_sql(labelled_ctes: list[str]) -> str:
    """The pooled table by plain SQL: every hold's statistics counted on their own."""
    ks = ", ".join(f"({k})" for k in WORDS_TO_KEEP)
    ctes = [
        *labelled_ctes,  # ld, rk, sz, sp
        "fd AS (SELECT doc_id, text, label, CAST((rank - 1) % 10 AS INTEGER) AS fold FROM sp WHERE part = 'train')",
        Q.term_counts_cte(src="fd"),
        "hd AS (SELECT CAST(range AS INTEGER) AS hold FROM range(10))",
        "ht AS (SELECT hd.hold, tc.label, tc.term, sum(tc.f) AS c, count(*) AS d FROM tc JOIN fd ON tc.doc_id = fd.doc_id JOIN hd ON fd.fold <> hd.hold GROUP BY ALL)",
        "hn AS (SELECT hd.hold, count(*) AS n FROM fd JOIN hd ON fd.fold <> hd.hold GROUP BY hd.hold)",
        "hr AS (SELECT hold, term, min(rk) AS rk FROM (SELECT hold, term, rank() OVER (PARTITION BY hold, label ORDER BY c DESC) AS rk FROM ht) AS x GROUP BY hold, term)",
        "hm AS (SELECT ht.hold, ht.term, min(hr.rk) AS rk, ln(min(hn.n)::DOUBLE / sum(ht.d)) AS idf, "
        "round(ln((coalesce(sum(CASE WHEN label = 'spam' THEN c END), 0) + 1.0) / (coalesce(sum(CASE WHEN label = 'ham' THEN c END), 0) + 1.0)), 6) AS coef "
        "FROM ht JOIN hr ON ht.hold = hr.hold AND ht.term = hr.term JOIN hn ON ht.hold = hn.hold GROUP BY ht.hold, ht.term)",
        f"ks AS (SELECT * FROM (VALUES {ks}) AS v(k))",
        f"sm AS (SELECT ks.k, fd.doc_id, fd.label, {CV_INTERCEPT} + coalesce(sum(CASE WHEN hm.rk <= ks.k THEN ln(1 + tc.f) * hm.idf * hm.coef END), 0) AS margin "
        "FROM fd JOIN ks ON true LEFT JOIN tc ON fd.doc_id = tc.doc_id LEFT JOIN hm ON hm.hold = fd.fold AND hm.term = tc.term GROUP BY ks.k, fd.doc_id, fd.label)",
        "pl AS (SELECT CAST(k AS INTEGER) AS k, count(*) AS n, count(*) FILTER (WHERE label = 'spam' AND margin > 0) AS hit, "
        "count(*) FILTER (WHERE margin > 0) AS said, count(*) FILTER (WHERE label = 'spam') AS spam_docs FROM sm GROUP BY k)",
        "pf AS (SELECT k, n, hit, said, spam_docs, round(CASE WHEN hit > 0 THEN 2.0 * hit / (said + spam_docs) END, 6) AS f_spam FROM pl)",
    ]
    return "WITH " + ", ".join(ctes) + " "
