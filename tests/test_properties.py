"""Property tests and plan-shape checks (SURVEY 4)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailspark.config import VectorizerConfig
from mailspark.functions.text import clean_text
from mailspark.operators import terms as TM
from mailspark.operators import vocab as V
from mailspark.sources.tables import labelled_docs

ALPHABET = st.sampled_from(list("aZé É5 @.'\n\t:/hpstwÑñü-") + ["http://", "https://", "x@y.z"])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=20))
def test_clean_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = df.select(clean_text("t").alias("a")).select("a", clean_text("a").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "dd", "e"]), max_size=12).map(" ".join), min_size=1, max_size=8))
def test_in_row_counts_equal_group_by(spark, texts):
    docs = spark.createDataFrame([(i, t, "ham") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, label STRING")
    a = TM.doc_term_counts(docs, VectorizerConfig()).select("doc_id", "term", "f")
    toks = docs.select("doc_id", F.explode(F.split("text", " ")).alias("term")).filter(F.col("term") != "")
    b = toks.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("f"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_topk_window_sees_frequencies_only(spark):
    """The class window ranks counted frequencies: no task sees a class's terms, and no session setting changes."""
    counts = TM.doc_term_counts(labelled_docs(spark, "/root/testdata/sf0.001"), VectorizerConfig())
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", None)
    for k in (100, 5000):
        plan = V.class_topk(TM.class_term_stats(counts), k)._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.split("\n") if "Window " in line]
        assert windows and not any("term" in line for line in windows), k
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", None) == before


def test_vocabulary_is_the_same_under_any_threshold(spark):
    cfg = VectorizerConfig(words_to_keep=50)
    counts = TM.doc_term_counts(labelled_docs(spark, "/root/testdata/sf0.001"), cfg)
    tables = []
    for most in ("-1", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        tables.append(sorted(map(tuple, V.fit_vocabulary(counts, 80, cfg).table.collect())))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tables[0] == tables[1] and sorted(r[1] for r in tables[0]) == list(range(len(tables[0])))


def test_scoring_plan_broadcasts_model(spark):
    from mailspark.plans.train import fit_text_model, score_docs

    docs = labelled_docs(spark, "/root/testdata/sf0.001")
    m = fit_text_model(docs, VectorizerConfig(words_to_keep=20), 1.0, 20)
    plan = score_docs(docs, m)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "partial_sum" in plan


def _formatted_nodes(df):
    """``(node name, its 'Input' line)`` pairs from ``explain('formatted')``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    nodes, name = [], None
    for line in buf.getvalue().splitlines():
        if line.startswith("(") and ")" in line:
            name = line.split(")", 1)[1].strip()
        elif line.startswith("Input") and name:
            nodes.append((name, line))
    return nodes


def test_split_never_windows_the_text(spark):
    """The hold-out split ranks only (stratum, hash, id): no Window or Sort
    node of the plan receives the text column."""
    from mailspark.operators.split import stratified_split

    docs = labelled_docs(spark, "/root/testdata/sf0.001")
    nodes = _formatted_nodes(stratified_split(docs))
    ranked = [(n, i) for n, i in nodes if n.startswith(("Window", "Sort"))]
    assert ranked
    for n, inp in ranked:
        assert "text#" not in inp, (n, inp)


def test_term_counts_have_no_exchange(spark):
    """In-row counting: from the documents to (doc, term, f) there is no
    shuffle besides the label join."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = TM.doc_term_counts(docs, VectorizerConfig(), keep=("doc_id",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "HashAggregate" not in plan
