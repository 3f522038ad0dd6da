"""Per-class top-K vocabulary and term weights.

Fitting reads training documents only ("test-blind", V7): the vocabulary,
the training size N and the document frequencies come from them, and the
same table is then applied to any other frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import VectorizerConfig
from mailspark.operators.ranking import bucketed_row_number
from mailspark.operators.terms import class_term_stats


def count_ranks(stats: DataFrame, k: int, group: list[str]) -> DataFrame:
    """``group + (c, rk)``: the rank of each corpus frequency that a group's
    top K holds. Frequencies are counted first, so the window sees a group's
    distinct frequencies, not its terms; at most K rows per group are left."""
    counted = stats.groupBy(*group, "c").agg(F.count(F.lit(1)).alias("_n"))
    larger = Window.partitionBy(*group).orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("_n").over(larger), F.lit(0)) + 1
    return counted.select(*group, "c", rank.alias("rk")).filter(F.col("rk") <= k)


def class_topk(stats: DataFrame, k: int, class_col: str = "label") -> DataFrame:
    """Rows of ``(label, term, c, ...)`` whose class rank by ``c`` is at
    most K; every term tied at the cut is kept. No task sees a whole class:
    the ranks of the frequencies (at most K per class, so broadcast) are
    joined to the terms in place."""
    ranks = count_ranks(stats, k, [class_col])
    return stats.join(F.broadcast(ranks), [class_col, "c"])


def vocab_terms(stats: DataFrame, k: int, class_col: str = "label") -> DataFrame:
    """Union over classes of the class top-K terms."""
    return class_topk(stats, k, class_col).select("term").distinct()


@dataclass
class Vocabulary:
    """A fitted vectorizer: ``table(term, idx, df, n_train)`` plus settings."""

    cfg: VectorizerConfig
    table: DataFrame
    n_train: int
    size: int

    def joinable(self) -> DataFrame:
        """The table is cached, so Spark knows its bytes and picks the join."""
        return self.table

    def unpersist(self):
        self.table.unpersist()


def fit_vocabulary(train_counts: DataFrame, n_train: int, cfg: VectorizerConfig, stats: DataFrame | None = None) -> Vocabulary:
    """Fit W1 + A3 on training term counts ``(doc_id, label, term, f)``.

    ``n_train`` is the number of training *documents* (documents without a
    term count too). ``stats`` may pass precomputed ``(label, term, c, d)``.
    The fitted table is small (K per class plus ties) and is cached; its
    measured size decides between a broadcast and a shuffle join later.
    """
    own = stats is None
    if own:
        stats = class_term_stats(train_counts).persist(StorageLevel.MEMORY_AND_DISK)
    terms = vocab_terms(stats, cfg.words_to_keep).persist(StorageLevel.MEMORY_AND_DISK)
    size = terms.count()
    df_ = stats.join(terms, "term").groupBy("term").agg(F.sum("d").alias("df"))
    # any dense number will do; one rule at every size, without a global sort
    indexed = bucketed_row_number(df_.withColumn("_h", F.md5("term")), [], "_h", "term", out="_rn")
    table = indexed.select(
        "term",
        (F.col("_rn") - 1).cast("int").alias("idx"),
        F.col("df").cast("long").alias("df"),
        F.lit(int(n_train)).cast("long").alias("n_train"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    table.count()
    terms.unpersist()
    if own:
        stats.unpersist()
    return Vocabulary(cfg, table, int(n_train), size)


def weight_expr(cfg: VectorizerConfig, f: Column, df: Column, n: Column) -> Column:
    """V1-V3: BINARY 1; TF ln(1+f); TF-IDF ln(1+f) * ln(N/df)."""
    if cfg.weighting == "BINARY":
        return F.lit(1.0)
    tf = F.log1p(f.cast("double"))
    if cfg.weighting == "TF":
        return tf
    return tf * F.log(n.cast("double") / df.cast("double"))


def transform(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """V7 apply: ``(doc_id, [label,] term, idx, weight)`` for the document
    terms that are in the vocabulary."""
    keep = [c for c in counts.columns if c not in ("term", "f")]
    j = counts.join(vocab.joinable(), "term")
    return j.select(*keep, "term", "idx", weight_expr(vocab.cfg, F.col("f"), F.col("df"), F.col("n_train")).alias("weight"))


def hold_stats(fold_stats: DataFrame, n_folds: int) -> DataFrame:
    """``(hold, label, term, c, d)``: the statistics of every "all folds but
    ``hold``", and of all folds as hold ``n_folds``, in one aggregation.

    ``fold_stats`` is ``(fold, label, term, c, d)``. One group per (label, term)
    keeps the folds' shares side by side; a hold is the total less its share."""
    part = lambda x, i: F.coalesce(F.sum(F.when(F.col("fold") == i, F.col(x))), F.lit(0))
    shares = [F.struct(part("c", i).alias("c"), part("d", i).alias("d")) for i in range(n_folds)]
    none = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("d"))
    whole = fold_stats.groupBy("label", "term").agg(F.sum("c").alias("_c"), F.sum("d").alias("_d"), F.array(*shares, none).alias("_shares"))
    return (
        whole.select("label", "term", "_c", "_d", F.posexplode("_shares").alias("hold", "_s"))
        .select("hold", "label", "term", (F.col("_c") - F.col("_s.c")).alias("c"), (F.col("_d") - F.col("_s.d")).alias("d"))
        .filter("d > 0")
    )


def fold_term_ranks(fold_stats: DataFrame, k: int, n_folds: int) -> DataFrame:
    """``(hold, term, rk, df)``: W1 + A3 for every hold of ``hold_stats`` at
    once. ``rk`` is a term's best class rank, so the vocabulary of any smaller
    K is ``rk <= K``; ``df`` counts the hold's documents of all classes."""
    st = hold_stats(fold_stats, n_folds)
    ranks = count_ranks(st, k, ["hold", "label"])  # at most K rows per hold and class
    best = st.join(F.broadcast(ranks), ["hold", "label", "c"]).groupBy("hold", "term").agg(F.min("rk").alias("rk"))
    # broadcast: at most K terms per hold and class, plus ties
    return st.join(F.broadcast(best), ["hold", "term"]).groupBy("hold", "term").agg(F.first("rk").alias("rk"), F.sum("d").alias("df"))
