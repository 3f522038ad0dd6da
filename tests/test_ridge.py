"""The joint solver, the restartable grid, the optimality certificate and the model store."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailspark.config import GridSpec, VectorizerConfig
from mailspark.operators import ridge
from mailspark.operators.evaluate import f_of_counts
from mailspark.operators.model import TextModel, doc_vectors, fit_logistic, gradient_at, load_model, model_versions, save_model, sized_partitions, with_y
from mailspark.operators.ridge import Fit, fit_all, pack_blocks, persist_blocks
from mailspark.operators.split import stratified_split, train_folds
from mailspark.operators.terms import doc_term_counts
from mailspark.operators.vocab import fit_vocabulary
from mailspark.plans import tune
from mailspark.plans.train import train_final
from mailspark.session import scratch_table_path
from mailspark.sources.tables import labelled_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folded(spark):
    docs = labelled_docs(spark, SF)
    train = stratified_split(docs).filter(F.col("part") == "train").select("doc_id", "text", "label")
    return train.join(train_folds(train, 3), "doc_id").cache()


def single(folded, cfg, ridge, fold, max_iter=500, tol=1e-12):
    """One fold's fit by Spark ML: the model by term, and the held-out confusion counts."""
    train = folded.filter(F.col("fold") != fold)
    counts = doc_term_counts(folded, cfg, keep=("doc_id", "label", "fold"), outer=True).cache()
    n = train.count()
    vocab = fit_vocabulary(counts.filter((F.col("fold") != fold) & F.col("term").isNotNull()), n, cfg)
    vec = with_y(doc_vectors(counts, vocab, keep=("doc_id", "label", "fold"))).cache()
    lr = fit_logistic(vec.filter(F.col("fold") != fold), ridge, n, max_iter, tol)
    terms = {r["idx"]: r["term"] for r in vocab.table.collect()}
    rows = lr.transform(vec.filter(F.col("fold") == fold)).groupBy("label", "prediction").count().collect()
    cells = {(r["label"], "spam" if r["prediction"] == 1 else "ham"): r["count"] for r in rows}
    return {terms[i]: c for i, c in enumerate(lr.coefficients.toArray())}, lr.intercept, cells


def test_joint_fits_equal_spark_ml(spark, folded, monkeypatch):
    """Three kinds, two K and two ridges fitted together; three points against single fits."""
    seen, names = [], {}
    real, packed = tune.fit_all, tune.pack_blocks

    def keep(blocks, fits, *rest):
        seen.extend(fits)
        return real(blocks, fits, *rest)

    def names_of(counts, terms, tok):
        names[tok] = {r["idx"]: r["term"] for r in terms.collect()}
        return packed(counts, terms, tok)

    monkeypatch.setattr(tune, "fit_all", keep)
    monkeypatch.setattr(tune, "pack_blocks", names_of)
    cfgs = [VectorizerConfig.for_kind(k, words_to_keep=30) for k in ("TF_IDF", "BINARY", "TF_IDF_BIGRAMS")]
    rows = tune.cross_validate(folded, cfgs, [10, 30], [10.0], 3, 500, tol=1e-10)
    assert {r[:3] for r in rows} == {(c.kind, k, 10.0) for c in cfgs for k in (10, 30)}
    for cfg in cfgs:
        want, intercept, cells = single(folded, cfg, 10.0, 0)
        m = next(m for m in seen if m.hold == 0 and m.key == (cfg.kind, 30, 10.0))
        coef, free = m.coefficients()
        # coefficients of weighted features, as Spark ML has them
        ours = {names[m.tok][j]: c for j, c in zip(m.cols, coef)}
        assert set(ours) <= set(want)
        assert max(abs(ours.get(t, 0.0) - c) for t, c in want.items()) < 1e-4 and abs(free - intercept) < 1e-4
        assert dict(zip(tune.CELLS, m.confusion)) == {c: cells.get(c, 0) for c in tune.CELLS}
        pooled = sum(m.confusion for m in seen if m.key == (cfg.kind, 30, 10.0))
        assert next(r[4] for r in rows if r[:3] == (cfg.kind, 30, 10.0)) == f_of_counts(dict(zip(tune.CELLS, map(int, pooled))))


def test_rounds_have_one_job_and_few_rows(spark, folded):
    """What reaches the driver does not grow with the blocks."""
    counts = doc_term_counts(folded, VectorizerConfig(), keep=("doc_id", "label", "fold"), outer=True)
    terms = spark.createDataFrame([("the", 0), ("of", 1)], "term STRING, idx INT")
    blocks = persist_blocks([pack_blocks(counts, terms, 0)], 4)
    one = np.ones(2)
    fits = [Fit(("x", 1, r), 0, True, h, np.arange(2), one, one, one, 50, 20, r) for h in range(3) for r in (1.0, 2.0)]
    done = []
    assert 0 < fit_all(blocks, fits, {0: 2}, 50, 1e-8, done.extend) < 100
    assert len(done) == 6 and all(m.confusion.sum() > 0 for m in done)
    blocks.unpersist()


def test_one_class_and_empty_folds(spark):
    rows = [(i, f"word{i} common", "ham", i % 2) for i in range(6)] + [(10, "", "ham", 0)]
    folded = spark.createDataFrame(rows, "doc_id long, text string, label string, fold int")
    got = tune.cross_validate(folded, [VectorizerConfig(words_to_keep=5)], [5], [1.0], 3, 20)
    assert [(r[0], r[4]) for r in got] == [("TF_IDF", None)]


def test_grid_goes_on_where_it_stopped(spark, monkeypatch):
    docs = labelled_docs(spark, SF)
    grid = GridSpec(vectorizers=("BINARY", "TF"), words_to_keep=(20,), ridges=(1.0, 10.0), n_folds=2, max_iter=30, stopwords=None)
    log = scratch_table_path(spark, "grid-log")
    whole = tune.grid_search(docs, grid)

    class Stop(Exception):
        pass

    real, points = tune.append_grid_log, []

    def stop(spark, path, digest, rows):
        for r in rows:
            if len(points) == 2:
                raise Stop
            real(spark, path, digest, [r])
            points.append(r)

    monkeypatch.setattr(tune, "append_grid_log", stop)
    with pytest.raises(Stop):
        tune.grid_search(docs, grid, log)
    monkeypatch.setattr(tune, "append_grid_log", real)
    fitted, fits = [], tune.fit_all
    monkeypatch.setattr(tune, "fit_all", lambda b, ms, *a: (fitted.extend(ms), fits(b, ms, *a))[1])
    again = tune.grid_search(docs, grid, log)
    assert len({m.key for m in fitted}) == 2 and not {m.key for m in fitted} & {(p[0], p[2], p[3]) for p in points}
    assert again.collect() == whole.collect()
    fitted.clear()
    # all there: nothing is fitted, and the winner comes from the log
    results, best = tune.tune(docs, grid, log)
    assert not fitted and results.collect() == whole.collect() and best.count() <= 1
    # other data, other settings
    assert tune.grid_digest(docs.limit(50), grid) != tune.grid_digest(docs, grid)
    assert tune.grid_digest(docs, GridSpec(n_folds=2, max_iter=31, stopwords=None)) != tune.grid_digest(docs, grid)


def test_gradient_tells_the_optimum(spark):
    docs = labelled_docs(spark, SF)
    cfg = VectorizerConfig(words_to_keep=30, weighting="TF")
    model = train_final(docs, cfg, ridge=2.0)
    counts = doc_term_counts(docs, cfg, keep=("doc_id", "label"), outer=True)
    at = {r["term"]: r["gradient"] for r in gradient_at(counts, model, 2.0).collect()}
    assert len(at) == model.size + 1 and None in at and max(map(abs, at.values())) < 1e-4
    # by hand
    n = docs.count()
    vocab = fit_vocabulary(counts.filter(F.col("term").isNotNull()), n, cfg)
    moved = TextModel(model.terms.withColumn("coef", F.col("coef") + 0.05), model.intercept, n, 2.0, cfg, model.size)
    rows = with_y(doc_vectors(counts, vocab)).collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["y"] for r in rows])
    place = {r["term"]: r["idx"] for r in vocab.table.collect()}
    coef = {r["term"]: r["coef"] for r in moved.terms.collect()}
    b = np.zeros(len(place))
    for t, i in place.items():
        b[i] = coef[t]
    p = 1 / (1 + np.exp(-(x @ b + model.intercept)))
    sd = x.std(axis=0, ddof=1)
    want = ((p - y) @ (x - x.mean(axis=0))) / sd / n + 2 * 2.0 / n * b * sd
    got = {r["term"]: r["gradient"] for r in gradient_at(counts, moved, 2.0).collect()}
    assert all(abs(got[t] - want[i]) < 1e-9 for t, i in place.items()) and abs(got[None] - (p - y).mean()) < 1e-9
    assert max(map(abs, got.values())) > 1e-3


def test_store_never_mixes_versions(spark):
    path = scratch_table_path(spark, "store")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)

    def model(x):
        terms = spark.createDataFrame([("a", 0, 1.0, float(x)), ("b", 1, 1.0, float(x))], "term string, idx int, idf double, coef double")
        return TextModel(terms, float(x), 5, 1.0, VectorizerConfig(), 2)

    failed = []

    def write(x):
        try:
            for k in range(3):
                save_model(model(10 * x + k), path)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(x,)) for x in (1, 2, 3)]
    for w in writers:
        w.start()
    while any(w.is_alive() for w in writers):
        if model_versions(spark, path):
            m = load_model(spark, path)
            assert {r["coef"] for r in m.terms.collect()} == {m.intercept}
    assert not failed and sorted(model_versions(spark, path)) == list(range(1, 10))
    assert sorted(load_model(spark, path, version=v).intercept for v in range(1, 10)) == [10.0 * x + k for x in (1, 2, 3) for k in range(3)]


def test_partitions_by_bytes(spark):
    rows = spark.range(200_000, numPartitions=16).withColumn("x", F.rand(1)).persist()
    rows.count()
    assert sized_partitions(rows) == 1 and sized_partitions(rows, target=400_000) >= 4
    rows.unpersist()


def test_shared_second_derivatives_save_rounds(spark, monkeypatch):
    """Terms that come together: fewer rounds to the same optimum, and TF and TF-IDF, one problem, are fitted once."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(240):
        topic = draw.integers(0, 4)
        text = " ".join([f"a{topic}"] * draw.integers(1, 4) + [f"b{topic}"] * draw.integers(0, 3) + [f"c{x}" for x in draw.integers(0, 12, 8)])
        rows.append((i, text.translate(str.maketrans("0123456789", "qwertyuiop")), "spam" if draw.random() < 0.15 + 0.2 * topic else "ham", i % 3))
    folded = spark.createDataFrame(rows, "doc_id long, text string, label string, fold int").cache()
    cfgs = [VectorizerConfig.for_kind(k) for k in ("TF", "TF_IDF")]
    seen, widest, rounds = [], [], []
    real, one_round = tune.fit_all, ridge._round

    def keep(blocks, fits, *rest):
        seen.append(fits)
        rounds.append(real(blocks, fits, *rest))

    monkeypatch.setattr(tune, "fit_all", keep)
    monkeypatch.setattr(ridge, "_round", lambda blocks, groups: (widest.append(sum(g.w.shape[1] for g in groups)), one_round(blocks, groups))[1])
    points = tune.cross_validate(folded, cfgs, [20], [1e-4, 1.0], 3, 500, tol=1e-10)
    assert len(seen[0]) == 12 and max(widest) == 6 and len(points) == 4
    monkeypatch.setattr(ridge, "_curves", lambda *a: None)
    plain = tune.cross_validate(folded, cfgs, [20], [1e-4, 1.0], 3, 500, tol=1e-10)
    assert rounds[0] < 0.7 * rounds[1], rounds
    assert sorted(points) == sorted(plain)
    by_key = {(m.key, m.hold): m for m in seen[1]}
    for m in seen[0]:
        (coef, free), (want, also) = m.coefficients(), by_key[m.key, m.hold].coefficients()
        assert np.allclose(coef, want, atol=1e-3) and abs(free - also) < 1e-3
