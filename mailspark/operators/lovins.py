"""T4: the Lovins stemmer (J. B. Lovins, "Development of a stemming
algorithm", 1968), with its list of endings as a parameter.

The longest ending that a word has and whose condition its stem meets is taken
off; at least two letters stay. Then the stem is recoded: one of a doubled
final consonant goes, and the first rule that fits changes the end. The paper's
294 endings are a table that no rule gives, so they come from a file of
``ending condition`` lines (``read_endings``) or a mapping; its 29 conditions
and its recoding rules are here.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values from the paper's appendices B and C. A condition is the least
# length of the stem, and what the stem must match. A recoding is an end of the
# stem and what takes its place, tried in this order.
# ---------------------------------------------------------------------------
CONDITIONS = {
    "A": (2, ""),
    "B": (3, ""),
    "C": (4, ""),
    "D": (5, ""),
    "E": (2, "[^e]$"),
    "F": (3, "[^e]$"),
    "G": (3, "f$"),
    "H": (2, "(t|ll)$"),
    "I": (2, "[^oe]$"),
    "J": (2, "[^ae]$"),
    "K": (3, "(l|i|u.e)$"),
    "L": (2, "([^uxs]|os)$"),
    "M": (2, "[^acem]$"),
    "N": (3, "(s...|[^s]..)$"),
    "O": (2, "[li]$"),
    "P": (2, "[^c]$"),
    "Q": (3, "[^ln]$"),
    "R": (2, "[nr]$"),
    "S": (2, "(dr|[^t]t)$"),
    "T": (2, "(s|[^o]t)$"),
    "U": (2, "[lmnr]$"),
    "V": (2, "c$"),
    "W": (2, "[^su]$"),
    "X": (2, "(l|i|u.e)$"),
    "Y": (2, "in$"),
    "Z": (2, "[^f]$"),
    "AA": (2, "(d|f|ph|th|l|er|or|es|t)$"),
    "BB": (3, "(?<!met)(?<!ryst)$"),
    "CC": (2, "l$"),
}
UNDOUBLED = "bdglmnprst"
RECODINGS = (
    ("iev", "ief"),
    ("uct", "uc"),
    ("umpt", "um"),
    ("rpt", "rb"),
    ("urs", "ur"),
    ("istr", "ister"),
    ("metr", "meter"),
    ("olv", "olut"),
    ("(?<![aoi])ul", "l"),
    ("bex", "bic"),
    ("dex", "dic"),
    ("pex", "pic"),
    ("tex", "tic"),
    ("ax", "ac"),
    ("ex", "ec"),
    ("ix", "ic"),
    ("lux", "luc"),
    ("uad", "uas"),
    ("vad", "vas"),
    ("cid", "cis"),
    ("lid", "lis"),
    ("erid", "eris"),
    ("pand", "pans"),
    ("(?<!s)end", "ens"),
    ("ond", "ons"),
    ("lud", "lus"),
    ("rud", "rus"),
    ("(?<![pt])her", "hes"),
    ("mit", "mis"),
    ("(?<!m)ent", "ens"),
    ("ert", "ers"),
    ("(?<!n)et", "es"),
    ("yt", "ys"),
    ("yz", "ys"),
)
SHORTEST = 2


def read_endings(spark: SparkSession, path: str) -> dict[str, str]:
    """Endings and their conditions from text lines ``ending condition``; blank
    lines and lines that begin with ``#`` don't count."""
    rows = (r["value"].split() for r in spark.read.text(path).collect())  # the list has some 300 lines
    return {r[0]: r[1] for r in rows if r and not r[0].startswith("#")}


def recode(stem: str) -> str:
    """The stem's end as the recoding rules spell it."""
    if len(stem) > 1 and stem[-1] == stem[-2] and stem[-1] in UNDOUBLED:
        stem = stem[:-1]
    for end, new in _recodings():
        if found := end.search(stem):
            return stem[: found.start()] + new
    return stem


@lru_cache(1)
def _recodings() -> tuple:
    return tuple((re.compile(f"{end}$"), new) for end, new in RECODINGS)


def lovins(endings: Mapping[str, str]) -> Callable[[str], str]:
    """A per-word function for ``VectorizerConfig(stemmer=...)``."""
    if unknown := {c for c in endings.values() if c not in CONDITIONS}:
        raise ValueError(f"unknown conditions {sorted(unknown)}")
    table = dict(endings)
    longest = max(map(len, table), default=0)

    def lovins_stem(word: str) -> str:
        word = word.lower()
        for size in range(min(longest, len(word) - SHORTEST), 0, -1):
            condition = table.get(word[-size:])
            if condition:
                stem = word[:-size]
                least, pattern = CONDITIONS[condition]
                if len(stem) >= least and re.search(pattern, stem):
                    return recode(stem)
        return recode(word) if len(word) > SHORTEST else word

    return lovins_stem
