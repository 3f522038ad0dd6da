"""T4: stemming words of token arrays.

A stemmer is a per-word function. It runs in Arrow batches over the token
arrays, once per word a task meets lately (a bounded memory), before n-grams
are built, so no term map is joined and no document is shuffled or lost.
``s_stem`` is a small published one (Harman 1991, the "S" stemmer).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED_WORDS = 200_000


def s_stem(word: str) -> str:
    """Plural endings: ``ies`` to ``y`` (not after a or e), ``es`` to ``e`` (not
    after a, e or o), ``s`` dropped (not after u or s); the first that fits."""
    if word.endswith("ies") and not word.endswith(("eies", "aies")):
        return word[:-3] + "y"
    if word.endswith("es") and not word.endswith(("aes", "ees", "oes")):
        return word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")):
        return word[:-1]
    return word


def stem_tokens(stem: Callable[[str], str]):
    """A function of a token-array column: each word replaced by its stem."""

    @F.pandas_udf("array<string>")
    def run(tokens: pd.Series) -> pd.Series:
        known = lru_cache(REMEMBERED_WORDS)(stem)
        return pd.Series([None if t is None else [known(w) for w in t] for t in tokens], dtype=object)

    return run


def stem_words(words: DataFrame, stem: Callable[[str], str]) -> DataFrame:
    """``(word)`` -> ``(word, stem)``."""
    return words.select("word", F.get(stem_tokens(stem)(F.array("word")), 0).alias("stem"))
