"""Text cleaning and small scalar functions.

All functions take and return ``Column`` and compile to native Spark
expressions (``regexp_replace``, ``lower``, ``split`` ...): no Python runs
per row. Spark's regular expressions are Java regular expressions, the same
engine the reference's cleaner uses, so patterns carry over unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results: the cleaning
# patterns in the order they are applied, the "unknown sender" word, the date
# pattern of a mail file name, the class names (ham = 0, spam = 1) and the
# train share with its half-up rounding.
# ---------------------------------------------------------------------------
EMAIL_PATTERN = r"(?<!\S)\S[^\s@]*+@\S+\.\S+"
URL_PATTERN = r"(http|https)://\S+"
NUMBER_PATTERN = r"\b\d+\b"
NON_ALPHABET_PATTERN = r"[^a-zA-Záéíóúñü' ]"
WHITESPACE_PATTERN = r"\s+"
# What P3, P4 and P6 together turn into one space: all that is neither a letter of the alphabet nor an apostrophe.
BETWEEN_WORDS_PATTERN = r"[^a-zA-Záéíóúñü']+"
UNKNOWN_SENDER = "ezezaguna"
FILE_DATE_FORMAT = "yyyy-MM-dd"
HAM, SPAM = "ham", "spam"
CLASSES = (HAM, SPAM)
TRAIN_RATIO = 0.8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_emails(c: Column | str) -> Column:
    """E-mail-like tokens (greedy on non-space) become one space. The matches
    are those of ``\\S+@\\S+\\.\\S+``: one starts where its run of non-space starts
    and may take the run's first @ after that. Saying so keeps the work on a
    long run in proportion to its length."""
    return F.regexp_replace(_col(c), EMAIL_PATTERN, " ")


def strip_urls(c: Column | str) -> Column:
    """URLs with a lower-case http/https scheme become one space."""
    return F.regexp_replace(_col(c), URL_PATTERN, " ")


def strip_numbers(c: Column | str) -> Column:
    """Free-standing digit runs become one space."""
    return F.regexp_replace(_col(c), NUMBER_PATTERN, " ")


def keep_alphabet(c: Column | str) -> Column:
    """Every character outside ASCII letters, the accented lower-case
    letters, apostrophe and space becomes one space."""
    return F.regexp_replace(_col(c), NON_ALPHABET_PATTERN, " ")


def squeeze_spaces(c: Column | str) -> Column:
    """Whitespace runs become one space, then spaces are trimmed."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_PATTERN, " "))


def clean_text(c: Column | str) -> Column:
    """The full cleaner, P1 -> P2 -> P3 -> P4 -> lower (P5) -> P6.

    Lower-casing comes after P4, so capital accented letters are removed
    rather than folded, exactly as in the reference. Line breaks need no
    separate step (S1c): P4 turns them into spaces. NULL stays NULL.

    P3, P4 and the squeezing of P6 are one pass: P3 and P4 put spaces for
    characters outside the alphabet (digits are), P5 makes no space, and P6
    makes one of any number of them.
    """
    return F.trim(F.lower(F.regexp_replace(strip_urls(strip_emails(c)), BETWEEN_WORDS_PATTERN, " ")))


def parse_sender(file_name: Column | str) -> Column:
    """Third dot-separated part of the file name, else the unknown word."""
    parts = F.split(_col(file_name), r"\.")
    return F.when(F.size(parts) >= 3, F.element_at(parts, 3)).otherwise(F.lit(UNKNOWN_SENDER))


def parse_sent_date(file_name: Column | str) -> Column:
    """Second dot-separated part parsed strictly as yyyy-MM-dd; NULL
    when absent or not a valid date."""
    parts = F.split(_col(file_name), r"\.")
    return F.when(
        F.size(parts) >= 2,
        F.try_to_date(F.element_at(parts, 2), FILE_DATE_FORMAT),
    )


def escape_text(c: Column | str) -> Column:
    """P10: backslash-quote gains one backslash; a bare quote is unchanged
    (plain string replace, not a regular expression)."""
    return F.replace(_col(c), F.lit('\\"'), F.lit('\\\\"'))


def prediction_line(prediction: Column | str, name: Column | str) -> Column:
    """``<label>, "<name>"``."""
    return F.concat(_col(prediction), F.lit(', "'), _col(name), F.lit('"'))


def raw_text_line(prediction: Column | str, text: Column | str) -> Column:
    """P10 + P11 for a text given as such: ``<label>, "<escaped text>"``."""
    return prediction_line(prediction, escape_text(text))


def encode_label(label: Column | str) -> Column:
    """ham -> 0, spam -> 1, anything else -> NULL."""
    lab = _col(label)
    return F.when(lab == HAM, F.lit(0)).when(lab == SPAM, F.lit(1))


def stratum(label: Column | str) -> Column:
    """``ham`` stays ham, every other label goes to the spam list."""
    return F.when(_col(label) == HAM, F.lit(HAM)).otherwise(F.lit(SPAM))


def decode_prediction(pred: Column | str) -> Column:
    """predicted index back to the class name."""
    return F.when(_col(pred) == 0, F.lit(HAM)).otherwise(F.lit(SPAM))


def train_size(n: Column | str, ratio: float = TRAIN_RATIO) -> Column:
    """``Math.round(n * ratio)`` (half-up), not SQL banker-free round."""
    return F.floor(_col(n) * F.lit(ratio) + F.lit(0.5)).cast("long")
