"""Seeded split and folds: exact sizes, disjoint, complete, equal to the
plain window (SURVEY 5.4)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mailspark.operators.ranking import bucketed_row_number, seeded_hash
from mailspark.operators.split import seeded_rank, stratified_split, train_folds
from mailspark.sources.tables import labelled_docs


def test_split_sizes_and_disjoint(spark):
    d = labelled_docs(spark, "/root/testdata/sf0.01").select("doc_id", "label")
    sp = stratified_split(d).cache()
    got = {(r["label"], r["part"]): r["n"] for r in sp.groupBy("label", "part").agg(F.count("*").alias("n")).collect()}
    assert got == {("ham", "train"): 278, ("ham", "test"): 70, ("spam", "train"): 41, ("spam", "test"): 10}
    assert sp.select("doc_id").distinct().count() == d.count() == sp.count()


def test_bucketed_equals_plain(spark):
    d = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("g"))
    d = d.withColumn("h", seeded_hash(12345, "doc_id"))
    a = bucketed_row_number(d, ["g"], "h", "doc_id", prefix_len=2).select("doc_id", "rn")
    b = d.select("doc_id", F.row_number().over(Window.partitionBy("g").orderBy("h", "doc_id")).alias("rn"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_folds_stratified(spark):
    d = labelled_docs(spark, "/root/testdata/sf0.01").select("doc_id", "label")
    tr = stratified_split(d).filter(F.col("part") == "train")
    f = tr.join(train_folds(tr, 10), "doc_id")
    per = f.groupBy("label", "fold").count().collect()
    for lab in ("ham", "spam"):
        sizes = [r["count"] for r in per if r["label"] == lab]
        assert max(sizes) - min(sizes) <= 1
    assert f.count() == tr.count() == f.select("doc_id").distinct().count()


def test_threshold_split_equals_rank_split(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 == 0, "spam").otherwise("ham").alias("label"))
    a = stratified_split(d).select("doc_id", "part")
    r = seeded_rank(d)
    n = r.groupBy("stratum").agg(F.floor(F.count("*") * 0.8 + 0.5).alias("k"))
    b = r.join(n, "stratum").select("doc_id", F.when(F.col("rank") <= F.col("k"), "train").otherwise("test").alias("part"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fold_ranks_equal_single_vocabularies(spark):
    """One pass at the largest K gives every hold's vocabulary for every K."""
    from mailspark.config import VectorizerConfig
    from mailspark.operators.split import train_folds
    from mailspark.operators.terms import doc_term_counts
    from mailspark.operators.vocab import fit_vocabulary, fold_term_ranks

    d = labelled_docs(spark, "/root/testdata/sf0.001")
    f = d.join(train_folds(d, 3), "doc_id")
    cfg = VectorizerConfig(words_to_keep=30)
    counts = doc_term_counts(f, cfg, keep=("doc_id", "label", "fold")).cache()
    stats = counts.groupBy("fold", "label", "term").agg(F.sum("f").alias("c"), F.count(F.lit(1)).alias("d")).cache()
    many = fold_term_ranks(stats, 60, 3).cache()
    for i in range(4):  # the last: all folds
        st_i = stats.filter(F.col("fold") != i).groupBy("label", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
        for k in (5, 30, 60):
            one = fit_vocabulary(None, 10, cfg.with_k(k), stats=st_i)
            a = {(r["term"], r["df"]) for r in many.filter((F.col("hold") == i) & (F.col("rk") <= k)).collect()}
            assert a == {(r["term"], r["df"]) for r in one.table.collect()} and len(a) == one.size
