"""Tokenising and in-row term counting.

All functions are Catalyst expressions (``split``, ``filter``,
``transform``, ``array_sort`` ...). Term counts per document are computed
inside the row from the sorted token array, so ``(doc, term, f)`` rows come
out of the scan stage without a shuffle or a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: after cleaning only space and apostrophe can separate words,
# and both are delimiters of the word tokenizer.
TOKEN_DELIMITERS = "[ ']+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(clean: Column | str) -> Column:
    """Split cleaned text on spaces and apostrophes, drop empty strings."""
    return F.filter(F.split(_col(clean), TOKEN_DELIMITERS), lambda w: w != F.lit(""))


def bigrams(tokens: Column | str) -> Column:
    """2-grams of a token array joined by one space; none for size < 2.

    ``sequence(0, n-2)`` counts down when n < 2, hence the guard.
    """
    a = _col(tokens)
    return F.when(
        F.size(a) >= 2,
        F.transform(F.sequence(F.lit(0), F.size(a) - 2), lambda i: F.concat(F.get(a, i), F.lit(" "), F.get(a, i + 1))),
    ).otherwise(F.array().cast("array<string>"))


def ngram12_tokens(tokens: Column | str) -> Column:
    """1-grams followed by 2-grams."""
    a = _col(tokens)
    return F.concat(a, bigrams(a))


def run_starts(sorted_tokens: Column | str) -> Column:
    """0-based positions where a run of equal values starts in a sorted
    array (empty for an empty array)."""
    s = _col(sorted_tokens)
    n = F.size(s)
    return F.filter(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
    )


def run_counts(sorted_tokens: Column | str, starts: Column | str) -> Column:
    """A1 in-row: ``array<struct<term STRING, f BIGINT>>`` from a sorted
    token array and its run starts. Pass column references, not inline
    expressions, so the sort and the scan for starts run once per row."""
    s, st = _col(sorted_tokens), _col(starts)
    n = F.size(s)
    return F.transform(
        st,
        lambda p, j: F.struct(
            F.get(s, p).alias("term"),
            (F.coalesce(F.get(st, j + 1), n) - p).cast("long").alias("f"),
        ),
    )
