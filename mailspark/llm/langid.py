"""Language identification (operator 4): averaged hashed subword embeddings under a linear softmax.

Text is lower-cased, everything but letters becomes a blank, and every run of 1 to 3 characters that starts in a word
or at its left edge is hashed into ``buckets`` rows of an embedding table. A document's vector is the mean of its rows;
a softmax layer over it gives language probabilities. Table and layer are trained by mini-batch stochastic gradient
descent in numpy, on the driver, on a bounded sample: about ``per_lang`` rows of each learned language, drawn by a hash
of doc_id and text, and no more than ``most_rows`` in all; tasks turn them into sparse counts first. One part of the sample is held back: there a temperature is
fitted, and the score below which a prediction is rejected, so that at most ``reject_share`` of the correctly predicted
held-back documents fall below it.

Prediction is one narrow pass over whole texts: the trained table times the layer is one small table (``buckets`` x
languages, a bounded closure), whose rows are summed per document. Null text or no letter: ``und``, score 0, rejected.
Without any labelled row every document is ``und``. Repeated rows count each. lang, source and doc_id are never inputs
of a prediction. Extra columns are ignored (``predict``) or kept (``keep_identified``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import byte_slices, starts, tidy


@dataclass(frozen=True)
class LangConfig:
    buckets: int = 1 << 14
    dim: int = 16
    grams: int = 3
    per_lang: int = 600  # bound of the labelled sample, in rows of a language (in expectation)
    most_rows: int = 300_000  # bound of the whole sample, shared by the languages (in expectation)
    epochs: int = 25
    batch: int = 32
    rate: float = 2.0
    calibration: float = 0.3
    reject_share: float = 0.002
    seed: int = 7


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    table: np.ndarray  # (langs, buckets): logits of one subword
    bias: np.ndarray
    temperature: float
    reject_below: float


_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once in a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def subwords(texts: list, cfg: LangConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of all subwords of ``texts``, the text each belongs to, and how many letters each text has."""
    whole = " ".join(["", *((t or "").lower().replace("\x00", " ") + "\x00" for t in texts)])
    code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    owner = np.cumsum(code == 0)  # the end mark of a text counts for the next, but is no letter
    letter = letters()[code]
    n_letters = np.bincount(owner[letter], minlength=len(texts) + 1)[: len(texts)]
    c = np.where(letter, code, 32).astype(np.uint64)
    out, whose = [], []
    h = np.zeros(len(c), np.uint64)
    inside = np.ones(len(c), bool)
    for n in range(1, cfg.grams + 1):
        h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :]
        inside = inside[: len(c) - n + 1] & (letter[n - 1 :] if n > 1 else True)
        # a gram holds letters, after a blank at most
        ok = inside & (letter[: len(c) - n + 1] if n == 1 else True)
        x = h[ok] * np.uint64(0x9E3779B97F4A7C15)
        out.append((x >> np.uint64(40)).astype(np.int64) & (cfg.buckets - 1))
        whose.append(owner[: len(c) - n + 1][ok])
    return np.concatenate(out), np.concatenate(whose), n_letters


def sparse_counts(sample: DataFrame, cfg: LangConfig) -> DataFrame:
    """``(doc_id, lang, bucket array, share array)`` of sampled documents, made by tasks."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2, 400_000):
                many = b.num_rows
                bucket, whose, _ = subwords(b.column(2).to_pylist(), cfg)
                keys, n = np.unique(whose * cfg.buckets + bucket, return_counts=True)
                doc = keys // cfg.buckets
                per = np.bincount(doc, minlength=many)[:many]
                total = np.bincount(doc, weights=n, minlength=many)
                off = pa.array(starts(per).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.ListArray.from_arrays(off, pa.array((keys % cfg.buckets).astype(np.int32))), pa.ListArray.from_arrays(off, pa.array((n / total[doc]).astype(np.float32)))],
                    ["doc_id", "lang", "bucket", "share"],
                )

    return sample.mapInArrow(run, "doc_id long, lang string, bucket array<int>, share array<float>")


def remainder():
    """crc32 of doc_id as text, modulo 4; a null doc_id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)), F.lit(0))


def labelled_sample(docs: DataFrame, cfg: LangConfig) -> DataFrame:
    """About ``per_lang`` rows of each language, fewer where all of them would pass ``most_rows``, by a hash of doc_id and text,
    among rows one may learn from. Rows that repeat both are one."""
    learn = docs.where((remainder() != 2) & F.col("lang").isNotNull())
    learn = learn.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text"))
    sizes = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    each = min(cfg.per_lang, cfg.most_rows / max(1, sizes.count()))
    # a row a language, and no more than the sample has
    sizes = F.broadcast(sizes.orderBy(F.desc("n"), "lang").limit(cfg.most_rows))
    draw = F.pmod(F.xxhash64(F.lit(cfg.seed), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return learn.where(F.col("text").isNotNull()).join(sizes, "lang").where(draw < each / F.col("n")).select("doc_id", "lang", "text").dropDuplicates()


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_numpy(rows: list, cfg: LangConfig) -> LangModel | None:
    """``rows``: (doc_id, lang, buckets, shares). Deterministic: rows are sorted, draws are seeded."""
    rows = sorted((r for r in rows if len(r[2])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return None
    langs = tuple(sorted({r[1] for r in rows}))
    y = np.array([langs.index(r[1]) for r in rows])
    rng = np.random.default_rng(cfg.seed)
    held = rng.random(len(rows)) < cfg.calibration
    learn = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    # every language weighs the same
    weight = 1 / np.bincount(y[learn], minlength=len(langs)).clip(1)
    weight *= len(learn) / weight[y[learn]].sum()
    table = rng.uniform(-1, 1, (cfg.buckets, cfg.dim)) / cfg.dim
    layer, bias = np.zeros((cfg.dim, len(langs))), np.zeros(len(langs))
    index = [np.asarray(r[2], np.int64) for r in rows]
    share = [np.asarray(r[3], np.float64) for r in rows]
    steps, step = cfg.epochs * -(-len(learn) // cfg.batch), 0
    for _ in range(cfg.epochs):
        order = rng.permutation(learn)
        for at in range(0, len(order), cfg.batch):
            some = order[at : at + cfg.batch]
            rate = cfg.rate * (1 - step / steps)
            step += 1
            mean = np.stack([share[i] @ table[index[i]] for i in some])
            err = softmax(mean @ layer + bias)
            err[np.arange(len(some)), y[some]] -= 1
            err *= weight[y[some], None] / len(some)
            back = err @ layer.T
            layer -= rate * mean.T @ err
            bias -= rate * err.sum(axis=0)
            for i, g in zip(some, back):
                table[index[i]] -= rate * len(some) * share[i][:, None] * g
    flat = (table @ layer).T
    check = np.flatnonzero(held) if held.any() else learn
    logits = np.stack([flat[:, index[i]] @ share[i] + bias for i in check])
    # calibration: one temperature by likelihood, then the score that rejects few correct predictions
    grid = np.geomspace(0.05, 5, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[check]])
    below = float(right[int(cfg.reject_share * len(right))]) if len(right) else 0.0
    return LangModel(langs, flat.astype(np.float32), bias, temperature, min(below, 0.5))


def fit(docs: DataFrame, cfg: LangConfig = LangConfig()) -> LangModel | None:
    """Learns from ``docs(doc_id, text, lang)``. What reaches the driver is bounded by ``most_rows`` rows of at
    most ``buckets`` counts."""
    rows = sparse_counts(labelled_sample(docs, cfg), cfg).collect()
    return fit_numpy([tuple(r) for r in rows], cfg)


def judge(texts: list, model: LangModel | None, cfg: LangConfig) -> tuple[list, np.ndarray, np.ndarray]:
    """Prediction, score and rejection of each text, over the whole text."""
    n = len(texts)
    if model is None:
        return ["und"] * n, np.zeros(n), np.ones(n, bool)
    bucket, whose, letters_in = subwords(texts, cfg)
    count = np.bincount(whose, minlength=n)[:n].clip(1)
    sums = [np.bincount(whose, weights=row[bucket], minlength=n)[:n] for row in model.table]
    p = softmax((np.stack(sums, axis=1) / count[:, None] + model.bias) / model.temperature)
    known = letters_in > 0
    score = np.where(known, p.max(axis=1), 0.0)
    names = [model.langs[i] if k else "und" for i, k in zip(p.argmax(axis=1), known)]
    return names, score, ~known | (score < model.reject_below)


def predict(docs: DataFrame, model: LangModel | None, cfg: LangConfig = LangConfig()) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` for every row of ``docs(doc_id, text)``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, 400_000):
                names, score, rejected = judge(b.column(1).to_pylist(), model, cfg)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (remainder() == 2).alias("held_out"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, cfg: LangConfig = LangConfig()) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; columns unchanged. One narrow pass: the text alone
    decides, so no join is needed."""
    model, at = fit(docs, cfg), docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, at, 400_000):
                yield b.filter(pa.array(~judge(b.column(at).to_pylist(), model, cfg)[2]))

    return docs.mapInArrow(run, docs.schema)
