"""Quality rules with risk-controlled cutoffs (operator 1).

Five rules look at ratios of a document: symbols per word, share of repeated lines, share of words in repeated
windows, and mean word length from above and below. Each rule has a fixed list of cutoffs from lenient to strict. In
every stratum, labelled good documents tell how often a cutoff rejects wrongly; the exact one-sided binomial
(Clopper-Pearson) bound of that rate must not exceed the rule's share of the allowed risk. Cutoffs of one rule are
tested in order from lenient on and the first failure ends the sequence, which needs no correction within the rule;
over rules and strata the confidence is divided (Bonferroni). So with probability ``1 - delta`` no stratum loses more
than ``alpha`` of its good documents. A stratum with too few labels certifies no cutoff and keeps what passes the
base rules.

Nulls, empty texts: no words, so ``base_failed``. Null ``lang`` and unlisted languages form the stratum ``other``.
Repeated rows are counted each; a document with contradicting labels is not good. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Stages

#: rule -> (expression over the features, side, cutoffs from lenient to strict)
RULES = {
    "symbols": ("n_symbols / n_words", ">", (2.0, 1.0, 0.5, 0.25, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", ">", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words / n_words", ">", (0.19, 0.17, 0.15, 0.13, 0.11, 0.1)),
    "long_words": ("word_chars / n_words", ">", (14.0, 12.0, 10.0, 9.0, 8.0, 7.0)),
    "short_words": ("word_chars / n_words", "<", (1.5, 2.0, 2.5, 3.0, 3.5, 4.0)),
}


@dataclass(frozen=True)
class Risk:
    """``alpha``: most good documents that a stratum may lose; ``delta``: probability that some bound fails."""

    alpha: float = 0.02
    delta: float = 0.05
    strata: tuple[str, ...] = ("en", "de", "fr", "es")


FEATURES = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_words(ids: np.ndarray) -> int:
    """Words lying in a 5-word window that occurs twice or more. Windows get exact numbers by pairing: pairs, then
    pairs of pairs, then those with the fifth word."""
    n = len(ids)
    if n < 6:
        return 0
    pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    four = np.unique(pair[:-2] * n + pair[2:], return_inverse=True)[1]
    five, count = np.unique(four[:-1] * n + ids[4:], return_inverse=True, return_counts=True)[1:]
    often = count[five] > 1
    if not often.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + 5, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes: splits at exactly \x20 and \x09-\x0D
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    blank = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in text.split("\n") if x.encode().split()] if "\n" in text else [text] * bool(words)
    repeat = repeated_words(ids) if len(seen) < len(words) else 0
    return len(words), len(text) - blank, symbols, len(lines) - len(set(lines)), repeat, len(lines)


def features(docs: DataFrame) -> DataFrame:
    """One row of counts per document of ``docs(doc_id, text, lang)``, over whole texts, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FEATURES.split(", ")]
        for b in batches:
            got = np.array([measure(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, 6)
            cols = [b.column(0), b.column(2), *(pa.array(got[:, i]) for i in range(6))]
            yield pa.RecordBatch.from_arrays(cols, names)

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return plain.mapInArrow(run, FEATURES)


def binomial_upper(k: int, n: int, error: float) -> float:
    """Exact upper confidence limit of a proportion after ``k`` of ``n``: the p with P(Bin(n, p) <= k) = error."""
    if k >= n:
        return 1.0
    j = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in j])
    lo, hi = 0.0, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        tail = np.exp(choose + j * math.log(p) + (n - j) * math.log1p(-p)).sum() if 0 < p < 1 else float(p == 0)
        lo, hi = (p, hi) if tail > error else (lo, p)
    return hi


def stratum(risk: Risk):
    return F.when(F.col("lang").isin(*risk.strata), F.col("lang")).otherwise(F.lit("other"))


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def tripped(rule: str, cutoff):
    value, side, _ = RULES[rule]
    return F.expr(value) > cutoff if side == ">" else F.expr(value) < cutoff


def certified_cutoffs(feats: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """``(stratum, <rule>...)``: the strictest certified cutoff of each rule, null where none is. At most one row for
    each listed stratum and ``other``."""
    good = (
        labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"))
    )
    held = feats.join(good.where("q = 1").select("doc_id"), "doc_id").where(~base_failed()).withColumn("stratum", stratum(risk))
    levels = [(r, j, c) for r, (_, _, cuts) in RULES.items() for j, c in enumerate(cuts)]
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *(F.count(F.when(tripped(r, c), 1)).alias(f"{r}_{j}") for r, j, c in levels)
    )
    error = risk.delta / (len(RULES) * (len(risk.strata) + 1))
    share = risk.alpha / len(RULES)

    @F.pandas_udf("double")
    def upper(k: pd.Series, n: pd.Series) -> pd.Series:
        # a bound beyond `share` is certain where even the observed rate exceeds it
        return pd.Series([1.0 if a > share * b else binomial_upper(a, b, error) for a, b in zip(k, n)], dtype=float)

    tests = counts.select(
        "stratum", "n",
        F.inline(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(j).alias("level"), F.lit(c).alias("cutoff"), F.col(f"{r}_{j}").alias("k")) for r, j, c in levels))),
    ).withColumn("fails", upper("k", "n") > share)
    first = tests.groupBy("stratum", "rule").agg(F.min(F.when(F.col("fails"), F.col("level"))).alias("bad"))
    passed = tests.join(first, ["stratum", "rule"]).where("bad is null or level < bad")
    strictest = F.struct("level", "cutoff")
    return passed.groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == r, strictest))["cutoff"].alias(r) for r in RULES)
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """``features`` with ``base_failed``, ``kept`` and the rules that rejected. ``docs(doc_id, text, lang)``,
    ``labels(doc_id, quality)``. The counts are written once and read twice (to certify and to judge)."""
    stages = Stages(docs.sparkSession, "quality")
    feats = stages.keep(features(docs))
    cuts = stages.keep(certified_cutoffs(feats, labels, risk).select("stratum", *(F.col(r).alias(f"cut_{r}") for r in RULES)))
    # broadcast: `cuts` has one row per listed stratum and one for the others
    judged = feats.withColumn("stratum", stratum(risk)).join(F.broadcast(cuts), "stratum", "left")
    judged = judged.withColumn("base_failed", base_failed())
    hits = F.array_compact(F.array(*(F.when(tripped(r, F.col(f"cut_{r}")), F.lit(r)) for r in RULES)))
    judged = judged.withColumn("rejected_by", F.when(F.col("n_words") > 0, F.array_join(hits, ",")).otherwise(F.lit("")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == "")).drop(*(f"cut_{r}" for r in RULES))
