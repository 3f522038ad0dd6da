"""Seeded order, exact stratified hold-out and stratified folds
(SURVEY 2.6 W2-W4, 2.2 F1, P12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailspark.config import N_FOLDS, SEED
from mailspark.functions.text import TRAIN_RATIO, stratum, train_size
from mailspark.operators.ranking import SEED_PREFIX_LEN, bucketed_row_number, seeded_hash


def stratum_counts(docs: DataFrame, label_col: str = "label") -> DataFrame:
    """F1 + A5: ``(stratum, n, n_train)`` per class."""
    return (
        docs.select(stratum(label_col).alias("stratum"))
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("n_train", train_size("n"))
    )


def seeded_rank(docs: DataFrame, id_col: str = "doc_id", label_col: str = "label", seed: int = SEED) -> DataFrame:
    """``docs + (stratum, h, rank)``; rank is 1-based within the
    stratum in seeded-hash order (doc id breaks hash ties)."""
    keyed = docs.withColumn("stratum", stratum(label_col)).withColumn("h", seeded_hash(seed, id_col))
    return bucketed_row_number(keyed, ["stratum"], "h", id_col, out="rank")


def train_thresholds(keyed: DataFrame, id_col: str = "doc_id", ratio: float = TRAIN_RATIO, prefix_len: int = SEED_PREFIX_LEN) -> DataFrame:
    """Per stratum, the sort key ``(h, id)`` of the last training document
    (the ``Math.round(n * ratio)``-th in seeded order): ``(stratum, t_h,
    t_id)``. Works on ``(stratum, h, id)`` only: bucket counts locate the
    bucket holding the cut, and only that bucket (1/16^prefix of a class)
    is ranked to find the exact key."""
    b = F.substring("h", 1, prefix_len)
    per_bucket = keyed.groupBy("stratum", b.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w_cls = Window.partitionBy("stratum")
    w_run = w_cls.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = per_bucket.select(
        "stratum",
        "_b",
        "_n",
        F.sum("_n").over(w_run).alias("_cum"),
        F.floor(F.sum("_n").over(w_cls) * F.lit(ratio) + F.lit(0.5)).alias("_k"),
    )
    # the bucket where the running count first reaches k, and the position in it
    cut = cum.filter((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_n") < F.col("_k"))).select(
        "stratum", "_b", (F.col("_k") - (F.col("_cum") - F.col("_n"))).alias("_pos")
    )
    # at most one row per stratum: a proven bound for the broadcast
    in_cut = keyed.withColumn("_b", b).join(F.broadcast(cut), ["stratum", "_b"])
    ranked = in_cut.withColumn("_r", F.row_number().over(Window.partitionBy("stratum").orderBy("h", id_col)))
    return ranked.filter(F.col("_r") == F.col("_pos")).select("stratum", F.col("h").alias("t_h"), F.col(id_col).alias("t_id"))


def stratified_split(
    docs: DataFrame, id_col: str = "doc_id", label_col: str = "label", seed: int = SEED, ratio: float = TRAIN_RATIO
) -> DataFrame:
    """``docs + (stratum, part)``; part ``train`` for the first
    ``Math.round(n * ratio)`` documents of each stratum in seeded order,
    else ``test``. Equal to ranking every document, but the document rows
    (with their text) are never shuffled or sorted: the per-stratum cut keys
    come from small jobs over ``(stratum, h, id)`` and are broadcast."""
    keyed = docs.withColumn("stratum", stratum(label_col)).withColumn("h", seeded_hash(seed, id_col))
    thr = train_thresholds(keyed.select("stratum", "h", id_col), id_col, ratio)
    is_train = (F.col("h") < F.col("t_h")) | ((F.col("h") == F.col("t_h")) & (F.col(id_col) <= F.col("t_id")))
    return (
        keyed.join(F.broadcast(thr), "stratum", "left")
        .withColumn("part", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
        .drop("t_h", "t_id", "h")
    )


def train_folds(train: DataFrame, n_folds: int = N_FOLDS, id_col: str = "doc_id", label_col: str = "label", seed: int = SEED) -> DataFrame:
    """W4 ids: ``(id, fold)`` for a training part, from the seeded rank of
    ``(id, label)`` only."""
    ids = train.select(id_col, label_col)
    return assign_folds(seeded_rank(ids, id_col, label_col, seed), n_folds).select(id_col, "fold")


def assign_folds(ranked: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """``fold = (rank - 1) % n_folds`` within the stratum, so every
    fold holds the same share of each class (sizes differ by at most one)."""
    return ranked.withColumn("fold", ((F.col("rank") - 1) % F.lit(n_folds)).cast("int"))


def stratified_folds(train: DataFrame, n_folds: int = N_FOLDS, id_col: str = "doc_id", label_col: str = "label", seed: int = SEED) -> DataFrame:
    """W4 on a training part: re-rank within class, then assign folds."""
    base = train.drop(*[c for c in ("stratum", "rank", "part", "h", "fold") if c in train.columns])
    return assign_folds(seeded_rank(base, id_col, label_col, seed), n_folds).drop("h")
