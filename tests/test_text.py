"""Cleaning, file names, escapes (FIXTURES 2, 3, 9)."""

import pytest
from pyspark.sql import functions as F

from mailspark.functions import text as T

CLEAN_CASES = [
    ("Hello WORLD 123", "hello world"),
    ("mail me: bob@x.com, now", "mail me now"),
    ("(bob@x.com)now ok", "ok"),
    ("see https://a.b/c?d=1 and http://q HTTP://KEEP.me", "see and http keep me"),
    ("abc123def 45", "abc def"),
    ("ÁRBOL árbol Ñandú NIÑO", "rbol árbol andú ni o"),
    ("don't  'quote'", "don't 'quote'"),
    ("", ""),
    ("12345 !!!", ""),
    ("a\nb\tc\r\nd", "a b c d"),
    ("x@y z@w.", "x y z w"),
    ("é5 5é", "é é"),
    ("http://u@h.com/p tail", "tail"),
    ("www.foo.com", "www foo com"),
]


def test_clean_cases(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CLEAN_CASES)], "i INT, t STRING")
    got = {r["i"]: r["c"] for r in df.select("i", T.clean_text("t").alias("c")).collect()}
    for i, (_, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, CLEAN_CASES[i]


def test_clean_null_and_idempotent(spark):
    df = spark.createDataFrame([(None,), ("Zz 9 é@x.com Ab'c",)], "t STRING")
    rows = df.select(T.clean_text("t").alias("a"), T.clean_text(T.clean_text("t")).alias("b")).collect()
    assert rows[0]["a"] is None
    assert rows[1]["a"] == rows[1]["b"]


def test_clean_idempotent_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    c = d.select(T.clean_text("text").alias("c"))
    assert c.filter(T.clean_text("c") != F.col("c")).count() == 0
    assert c.filter(F.col("c").rlike("[^a-záéíóúñü' ]|  |^ | $")).count() == 0


@pytest.mark.parametrize(
    "name,sender,date",
    [
        ("0006.2003-12-18.GP.spam.txt", "GP", "2003-12-18"),
        ("0007.2003-13-45.kay.ham.txt", "kay", None),
        ("x.2003-12-18.txt", "txt", "2003-12-18"),
        ("a.txt", "ezezaguna", None),
    ],
)
def test_file_names(spark, name, sender, date):
    r = spark.createDataFrame([(name,)], "n STRING").select(
        T.parse_sender("n").alias("s"), T.parse_sent_date("n").cast("string").alias("d")
    ).first()
    assert r["s"] == sender and r["d"] == date


def test_escape_and_line(spark):
    df = spark.createDataFrame([('a \\"b\\" "c"', "spam", "0006.2003-12-18.GP.spam.txt")], "t STRING, p STRING, n STRING")
    r = df.select(T.escape_text("t").alias("e"), T.prediction_line("p", "n").alias("l")).first()
    assert r["e"] == 'a \\\\"b\\\\" "c"'
    assert r["l"] == 'spam, "0006.2003-12-18.GP.spam.txt"'


def test_train_size(spark):
    ns = [1, 2, 3, 5, 11, 12, 348, 51]
    want = [1, 2, 2, 4, 9, 10, 278, 41]
    df = spark.createDataFrame([(n,) for n in ns], "n INT")
    assert [r[0] for r in df.select(T.train_size("n")).collect()] == want


def test_labels(spark):
    df = spark.createDataFrame([("ham",), ("spam",), ("other",)], "l STRING")
    rows = df.select(T.encode_label("l").alias("y"), T.stratum("l").alias("s")).collect()
    assert [r["y"] for r in rows] == [0, 1, None]
    assert [r["s"] for r in rows] == ["ham", "spam", "spam"]


def test_long_runs_clean_fast(spark):
    import time

    from mailspark.functions.text import clean_text

    texts = ["x" * 100_000, "@" * 100_000, "a@b.c" * 20_000, "x" * 100_000 + "@y.z q"]
    d = spark.createDataFrame([(t,) for t in texts], "t STRING").select(clean_text("t").alias("c"))
    d.collect()
    t0 = time.time()
    got = [r["c"] for r in d.collect()]
    assert time.time() - t0 < 10
    assert got == ["x" * 100_000, "", "", "q"]
