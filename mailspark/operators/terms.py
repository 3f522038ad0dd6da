"""Documents to terms and their counts.

``doc_term_counts`` yields one row per (document, distinct term) with the
in-document frequency ``f``. Counting happens inside each row (sorted token
array, run lengths) so this stage is a narrow map over the scan: no shuffle,
no hash table, and a document of any length is processed whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.config import VectorizerConfig
from mailspark.functions.text import clean_text
from mailspark.functions.tokens import TOKEN_DELIMITERS, ngram12_tokens, run_counts, run_starts, word_tokens
from mailspark.operators.stemming import stem_tokens


def stop_terms(stopwords) -> list[str]:
    """The stopword list through the word tokenizer, so that an entry with an
    apostrophe (``don't``) matches the tokens it is cut into."""
    return sorted({w for entry in stopwords for w in re.split(TOKEN_DELIMITERS, entry.lower()) if w})


def doc_tokens(docs: DataFrame, cfg: VectorizerConfig, text_col: str = "text", keep=("doc_id", "label")) -> DataFrame:
    """``keep`` columns + ``tokens ARRAY<STRING>``: cleaned, tokenised, words
    stemmed, then 2-grams, then the stopword test on the (stemmed) term (T6),
    so 2-grams never jump a gap. ``stop_before_stem`` tests the words as
    written, after which 2-grams join the words that are left. All in the row:
    a document whose terms are all stopwords keeps an empty array."""
    keep = [c for c in keep if c in docs.columns]
    out = docs.select(*keep, word_tokens(clean_text(F.col(text_col))).alias("tokens"))
    stop = stop_terms(cfg.stopwords) if cfg.stopwords else []
    unstopped = F.filter("tokens", lambda w: ~w.isin(stop))
    if stop and cfg.stop_before_stem:
        out = out.withColumn("tokens", unstopped)
    if cfg.stemmer != "none":
        out = out.withColumn("tokens", stem_tokens(cfg.stemmer)("tokens"))
    if cfg.bigrams:
        out = out.withColumn("tokens", ngram12_tokens("tokens"))
    if stop and not cfg.stop_before_stem:
        out = out.withColumn("tokens", unstopped)
    return out


def count_tokens(tokens: DataFrame, keep=("doc_id", "label"), outer: bool = False) -> DataFrame:
    """A1 from a token-array frame: ``keep + (term, f)``, one row per
    distinct term of each document. Documents without tokens give no row,
    or with ``outer`` one row with NULL term and f (kept for scoring, F5)."""
    keep = [c for c in keep if c in tokens.columns]
    sorted_ = tokens.select(*keep, F.sort_array("tokens").alias("_s"))
    with_starts = sorted_.select(*keep, "_s", run_starts("_s").alias("_st"))
    explode = F.explode_outer if outer else F.explode
    pairs = with_starts.select(*keep, explode(run_counts("_s", "_st")).alias("_p"))
    return pairs.select(*keep, F.col("_p.term").alias("term"), F.col("_p.f").alias("f"))


def doc_term_counts(
    docs: DataFrame, cfg: VectorizerConfig, text_col: str = "text", keep=("doc_id", "label"), outer: bool = False
) -> DataFrame:
    """A1: ``(doc_id, label, term, f)`` under the tokenizer / stemmer /
    stopword settings of ``cfg``; ``outer`` keeps token-less documents."""
    return count_tokens(doc_tokens(docs, cfg, text_col, keep), keep, outer)


def class_term_stats(counts: DataFrame, class_col: str = "label") -> DataFrame:
    """A2 + per-class document counts: ``(label, term, c, d)`` with
    ``c = sum(f)`` (corpus frequency in the class) and ``d`` = number of the
    class's documents containing the term. Map-side partial aggregation
    collapses frequent terms before the shuffle."""
    return counts.groupBy(class_col, "term").agg(F.sum("f").alias("c"), F.count(F.lit(1)).alias("d"))


def doc_freq(counts: DataFrame) -> DataFrame:
    """A3: ``(term, df)`` = number of documents containing the term."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
