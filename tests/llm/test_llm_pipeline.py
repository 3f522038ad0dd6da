"""Scores of language ID one by one, and the whole pipeline against a plain-Python chain."""

import math

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_llm_dedup import brute_near, brute_passages
from test_llm_output import PACK, check_packing, whole_ids
from test_llm_rules import brute_scan

import corpus_pipeline
from mailspark.llm import langid, passages, secret_scan

SF001 = "/root/testdata/sf0.001"


def brute_score(text, model, cfg):
    """(prediction, score, rejected): grams of 1 to 3 characters, each from a letter on or from the blank before one."""
    chars = [c if c.isalpha() else " " for c in " " + (text or "").lower()]
    logits, n = [0.0] * len(model.langs), 0
    for at in range(len(chars)):
        h = 0
        for size in range(1, cfg.grams + 1):
            if at + size > len(chars):
                break
            c = chars[at + size - 1]
            h = (h * 0x100000001B3 + ord(c)) % 2**64
            if c == " ":
                if size == 1:
                    continue
                break
            bucket = (h * 0x9E3779B97F4A7C15 % 2**64 >> 40) & (cfg.buckets - 1)
            n += 1
            for k in range(len(logits)):
                logits[k] += float(model.table[k][bucket])
    if not n:
        return "und", 0.0, True
    z = [(x / n + b) / model.temperature for x, b in zip(logits, model.bias)]
    top = max(z)
    p = [math.exp(x - top) for x in z]
    score = max(p) / sum(p)
    return model.langs[p.index(max(p))], score, score < model.reject_below


def test_scores_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cfg = langid.LangConfig(per_lang=40, epochs=5)
    model = langid.fit(docs, cfg)
    texts = [t[:3000] for t in pq.read_table(f"{SF001}/documents.parquet", columns=["text"])["text"].to_pylist()[:80]]
    texts += [None, "", "12 !?", "a", "É é", "ab1cd", "x\x00y", " lead", "日本語 text"]
    names, score, rejected = langid.judge(texts, model, cfg)
    for k, t in enumerate(texts):
        want = brute_score(t, model, cfg)
        assert names[k] == want[0] and abs(score[k] - want[1]) < 1e-6 and bool(rejected[k]) == want[2], t
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(rows, model, cfg).orderBy("doc_id").collect()] == [*zip(names, score.tolist())]


def test_long_texts_and_many_languages_are_learned(spark):
    rng = np.random.default_rng(4)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}
    rows = [(k, " ".join(word(alphabets[x]) for _ in range(6000 if x == "cc" else 20)), x) for k, x in enumerate(list(alphabets) * 12)]
    rows += [(5, "same id " + word("abc"), "aa") for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == ("aa", "bb", "cc")
    assert langid.judge([r[1] for r in rows[:36]], model, langid.LangConfig())[0] == [r[2] for r in rows[:36]]
    few = langid.LangConfig(most_rows=12)
    sizes = [langid.labelled_sample(docs.withColumn("text", F.concat("text", F.lit(f" {k}"))), few).count() for k in range(30)]
    assert 5 < np.mean(sizes) < 20


def test_pipeline_against_a_plain_chain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cfg, model = langid.LangConfig(), langid.fit(docs)
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    kept = {i: t for i, t in rows.items() if not brute_score(t, model, cfg)[2]}
    near = brute_near(list(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if near[i][2]}
    kept = {i: t for i, _, _, t in brute_passages(list(kept.items()), passages.Spans()) if not (kept[i].split() and not t.split())}
    for (i, t), spans in zip(list(kept.items()), brute_scan(list(kept.values()), secret_scan.Battery())):
        out, at = "", 0
        for a, _, b in spans:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        kept[i] = out + t[at:]
    ids = dict(zip(kept, whole_ids(kept.values())))
    assert len(ids) < len(rows)
    check_packing(corpus_pipeline.run(spark, SF001).collect(), ids, PACK)
