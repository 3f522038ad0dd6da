"""DuckDB SQL twins of the Spark operators, used as correctness oracles.

Each helper returns a SQL expression or CTE text that computes the same
thing as the matching Spark operator on the driver's views.
"""

from __future__ import annotations

import re

# The patterns are written out here again, so that a wrong one in the operators shows.
EMAIL_PATTERN = r"\S+@\S+\.\S+"
URL_PATTERN = r"https?://\S+"
NUMBER_PATTERN = r"\b[0-9]+\b"
NON_ALPHABET_PATTERN = r"[^a-zA-Záéíóúñü' ]"
WHITESPACE_PATTERN = r"\s+"
TOKEN_DELIMITERS = "[ ']+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_emails(x: str) -> str:
    return f"regexp_replace({x}, {q(EMAIL_PATTERN)}, ' ', 'g')"


def strip_urls(x: str) -> str:
    return f"regexp_replace({x}, {q(URL_PATTERN)}, ' ', 'g')"


def strip_numbers(x: str) -> str:
    return f"regexp_replace({x}, {q(NUMBER_PATTERN)}, ' ', 'g')"


def keep_alphabet(x: str) -> str:
    return f"regexp_replace({x}, {q(NON_ALPHABET_PATTERN)}, ' ', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WHITESPACE_PATTERN)}, ' ', 'g'))"


def clean_text(x: str) -> str:
    return squeeze(f"lower({keep_alphabet(strip_numbers(strip_urls(strip_emails(x))))})")


def word_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(TOKEN_DELIMITERS)}), lambda w: w <> '')"


def ngram12(tokens: str) -> str:
    return (
        f"list_concat({tokens}, CASE WHEN len({tokens}) >= 2 THEN "
        f"list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]) "
        "ELSE []::VARCHAR[] END)"
    )


LABELLED = (
    "SELECT d.doc_id, d.text, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)


def term_counts_cte(bigrams: bool = False, stopwords=None, src: str = "ld", prefix: str = "") -> str:
    """CTEs ``tk`` (doc_id, label, tokens) and ``tc`` (doc_id, label, term, f),
    names prefixed by ``prefix``."""
    toks = word_tokens(clean_text("text"))
    p = prefix
    tk = f"{p}tk0 AS (SELECT doc_id, label, {toks} AS tokens FROM {src})"
    if bigrams:
        tk += f", {p}tk1 AS (SELECT doc_id, label, {ngram12('tokens')} AS tokens FROM {p}tk0)"
    else:
        tk += f", {p}tk1 AS (SELECT * FROM {p}tk0)"
    if stopwords:
        # the test is on the term, so 2-grams are built first and stay as the text has them
        parts = sorted({w for entry in stopwords for w in re.split("[ ']+", entry.lower()) if w})
        lst = ", ".join(q(w) for w in parts)
        tk += f", {p}tk AS (SELECT doc_id, label, list_filter(tokens, lambda w: NOT list_contains([{lst}], w)) AS tokens FROM {p}tk1)"
    else:
        tk += f", {p}tk AS (SELECT * FROM {p}tk1)"
    return (
        tk + f", {p}tc AS (SELECT doc_id, label, term, count(*)::BIGINT AS f FROM "
        f"(SELECT doc_id, label, unnest(tokens) AS term FROM {p}tk) GROUP BY doc_id, label, term)"
    )


def vocab_cte(k: int, counts: str = "tc", n_docs: str = "(SELECT count(*) FROM ld)") -> str:
    """CTEs ``st`` (label, term, c, d), ``vt`` (term), ``vocab`` (term, df, n_train)."""
    return (
        f"st AS (SELECT label, term, sum(f) AS c, count(*) AS d FROM {counts} GROUP BY label, term), "
        f"vt AS (SELECT DISTINCT term FROM (SELECT term, rank() OVER (PARTITION BY label ORDER BY c DESC) AS rk FROM st) WHERE rk <= {k}), "
        f"vocab AS (SELECT st.term, sum(st.d)::BIGINT AS df, {n_docs}::BIGINT AS n_train FROM st JOIN vt ON st.term = vt.term GROUP BY st.term)"
    )


def weight_sql(weighting: str, f: str = "f", df: str = "df", n: str = "n_train") -> str:
    if weighting == "BINARY":
        return "1.0::DOUBLE"
    tf = f"ln(1 + {f})"
    if weighting == "TF":
        return tf
    return f"{tf} * ln({n}::DOUBLE / {df})"
