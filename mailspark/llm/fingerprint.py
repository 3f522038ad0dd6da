"""Document fingerprints by context-triggered piecewise hashing (operator 13).

A rolling hash of the last seven bytes runs over a text's UTF-8. At block size 3 * 2^k a chunk ends where the hash is one
less than a multiple of the block size; each chunk gives one of 64 letters, from a polynomial hash of its bytes. k starts at
the smallest one with 64 blocks or less for the text's length and falls while fewer than 32 letters come out. A signature
has at most 64 letters: the last covers all that is left. The fingerprint is ``block size:letters:letters at twice the block
size``. As 3 * 2^k divides hash + 1 exactly if 3 and 2^k do, one pass over the bytes serves all block sizes of all texts of
a slice.

``likeness`` compares two fingerprints at compatible block sizes, equal or double: one less the share of edits (Levenshtein)
in the longer signature, runs of more than three equal letters cut to three, the best of the sizes compared, and 0 where
the signatures share no run of letters (three, fewer for signatures below nine letters). Equal fingerprints have 1.

``edited_neighbours`` needs each document's next one. Rows are dealt out in ranges of (doc_id descending, hash of the text)
and sorted, so neighbours meet in a task but for the last row of each range, which waits in a written table for the first
row of the next range: one row a range, whatever the number of documents.

Null text counts as empty; the empty text's fingerprint is ``3::``. A null doc_id comes after all others. Rows that repeat a
doc_id are neighbours in the order of their texts' hashes. A table of one row is its own next. Empty table: no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Stages, byte_slices, tidy

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW, SMALLEST, MOST, FEW = 7, 3, 64, 32
#: Bytes looked at together; the powers' table has one entry for each.
SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(x: int, n: int) -> np.ndarray:
    """1, x, x^2, ... modulo 2^64."""
    return np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n - 1, x, np.uint64))]) if n > 1 else np.ones(1, np.uint64)


UP, DOWN = powers(BASE, SLICE), powers(INVERSE, SLICE)
UP_SLICE, DOWN_SLICE = pow(BASE, SLICE, 1 << 64), pow(INVERSE, SLICE, 1 << 64)


def rolled(x: np.ndarray, lead: int) -> np.ndarray:
    """The rolling hash after each byte of ``x[lead:]``: the last seven bytes' sum, weighted sum, and shifted exclusive or."""
    n = len(x) - lead
    x = x.astype(np.uint32)
    plain, weighted, shifted = (np.zeros(n, np.uint32) for _ in range(3))
    for k in range(WINDOW):
        c = x[lead - k : lead - k + n]
        plain += c
        weighted += c * np.uint32(WINDOW - k)
        shifted ^= c << np.uint32(5 * k)
    return plain + weighted + shifted


def signatures(texts: list[bytes]) -> list[str]:
    """Fingerprints of the texts."""
    # each text after seven zero bytes, which stand for the empty window
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + WINDOW) - sizes
    ends = starts + sizes
    zero = bytes(WINDOW)
    x = np.frombuffer(zero + zero.join(texts), np.uint8)
    at, twos, sums = [], [], []
    marks = np.sort(np.concatenate([starts, ends]))
    mark_sums, carry = [], np.uint64(0)
    for s in range(0, len(x), SLICE):
        part = x[s : s + SLICE]
        lead = min(WINDOW - 1, s)
        up = np.uint64(pow(UP_SLICE, s // SLICE, 1 << 64))
        before = np.concatenate([[carry], carry + np.cumsum(part * (UP[: len(part)] * up), dtype=np.uint64)])
        carry = before[-1]
        h = rolled(np.concatenate([np.zeros(WINDOW - 1 - lead, np.uint8), x[s - lead : s + len(part)]]), WINDOW - 1) + np.uint32(1)
        hit = np.flatnonzero((h % np.uint32(SMALLEST) == 0) & (h != 0))
        h = h[hit]
        at.append(hit + s)
        twos.append(np.bitwise_count((h & -h) - np.uint32(1)).astype(np.int8))
        sums.append(before[hit + 1])
        here = marks[(marks >= s) & (marks < s + len(part))]
        mark_sums.append(before[here - s])
    mark_sums.append(np.full(len(marks) - sum(map(len, mark_sums)), carry))
    sum_at = np.concatenate(mark_sums)
    start_sums, end_sums = sum_at[np.searchsorted(marks, starts)], sum_at[np.searchsorted(marks, ends)]
    at, twos, sums = np.concatenate(at), np.concatenate(twos), np.concatenate(sums)
    doc = np.searchsorted(starts, at, "right") - 1
    inside = (doc >= 0) & (at < ends[doc])
    at, twos, sums, doc = at[inside], twos[inside], sums[inside], doc[inside]
    # letters that each block size would give: chunks that end, and one that is left open
    most = 33
    ended = np.bincount(doc * most + twos, minlength=len(texts) * most).reshape(-1, most)[:, ::-1].cumsum(1)[:, ::-1]
    open_end = np.ones((len(texts), most), bool)
    closed = np.flatnonzero(at + 1 == ends[doc])
    for i in closed:
        open_end[doc[i], : twos[i] + 1] = False
    many = np.minimum(np.where(sizes[:, None] > 0, ended + open_end, 0), MOST)
    k = np.zeros(len(texts), np.int64)
    while (more := (SMALLEST * MOST << k) < sizes).any():
        k += more
    rows = np.arange(len(texts))
    while (less := (k > 0) & (many[rows, k] < FEW)).any():
        k -= less
    first = letters(k, at, twos, sums, doc, starts, ends, start_sums, end_sums)
    second = letters(k + 1, at, twos, sums, doc, starts, ends, start_sums, end_sums)
    return [f"{SMALLEST << e}:{a}:{b}" for e, a, b in zip(k.tolist(), first, second)]


def letters(k, at, twos, sums, doc, starts, ends, start_sums, end_sums) -> list[str]:
    """One text's letters after the other, at block size 3 * 2^k each."""
    n = len(starts)
    kept = twos >= k[doc]
    at, sums, doc = at[kept] + 1, sums[kept], doc[kept]
    rank = np.arange(len(doc)) - np.searchsorted(doc, np.arange(n))[doc]
    kept = (rank < MOST - 1) & (at < ends[doc])
    # a text's last chunk ends with it
    at = np.concatenate([at[kept], ends])
    sums = np.concatenate([sums[kept], end_sums])
    doc = np.concatenate([doc[kept], np.arange(n)])
    order = np.lexsort((at, doc))
    at, sums, doc = at[order], sums[order], doc[order]
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    begin = np.where(new, starts[doc], np.concatenate([[0], at[:-1]]))
    begin_sums = np.where(new, start_sums[doc], np.concatenate([[np.uint64(0)], sums[:-1]]))
    down, far = DOWN[begin % SLICE], begin // SLICE
    step = powers(DOWN_SLICE, int(far.max()) + 1)
    h = (sums - begin_sums) * down * step[far]
    h ^= h >> np.uint64(32)
    drawn = LETTERS[((h * np.uint64(BASE)) >> np.uint64(58)).astype(np.int64)]
    drawn, doc = drawn[at > begin], doc[at > begin]  # empty texts have no chunk
    raw, cut = drawn.tobytes().decode(), np.searchsorted(doc, np.arange(n + 1)).tolist()
    return [raw[a:b] for a, b in zip(cut, cut[1:])]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` for every row of ``docs(doc_id, text)``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, 1_000_000):
                prints = signatures([(t or "").encode() for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, fingerprint string")


def alike(a: Column, b: Column) -> Column:
    """Likeness of two signatures of one block size."""
    a, b = (F.regexp_replace(x, r"(.)\1{3,}", "$1$1$1") for x in (a, b))
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    run = F.greatest(F.lit(1), F.least(F.lit(3), F.floor(short / 3))).cast("int")

    def grams(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(x) - run + 1), lambda i: F.substring(x, i, run))

    share = F.lit(1.0) - F.levenshtein(a, b) / long
    return F.when((short > 0) & F.arrays_overlap(grams(a), grams(b)), share).otherwise(0.0)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    x, y = F.split(a, ":"), F.split(b, ":")
    size_x, size_y = x[0].cast("long"), y[0].cast("long")
    return (
        F.when(a == b, 1.0)
        .when(size_x == size_y, F.greatest(alike(x[1], y[1]), alike(x[2], y[2])))
        .when(size_x == 2 * size_y, alike(x[1], y[2]))
        .when(2 * size_x == size_y, alike(x[2], y[1]))
        .otherwise(0.0)
    )


DONE, LAST, FIRST = 0, 1, 2
FIELDS = (
    "kind int, part long, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "next_fingerprint string, text string"
)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the next one's beginning."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edit_rows(rows: list[tuple[int, int | None, str, str, str, str]]) -> pa.RecordBatch:
    """Finished rows from ``(part, doc_id, text, fingerprint, next text, next fingerprint)``."""
    texts = [edited(r[2], r[4]).encode() for r in rows]
    prints = signatures(texts) if texts else []
    cols = [
        pa.array([DONE] * len(rows), pa.int32()),
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([r[1] for r in rows], pa.int64()),
        pa.array([len(r[2]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        pa.array([r[3] for r in rows], pa.string()),
        pa.array(prints, pa.string()),
        pa.array([r[5] for r in rows], pa.string()),
        pa.array([None] * len(rows), pa.string()),
    ]
    return pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in FIELDS.split(", ")])


def end_row(kind: int, part: int, doc_id: int | None, text: str, fingerprint: str) -> pa.RecordBatch:
    values = [kind, part, doc_id, len(text), None, fingerprint, None, None, text]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [f.split()[0] for f in FIELDS.split(", ")])


def neighbours(docs: DataFrame) -> DataFrame:
    """The fields above: a finished row for every row but the last of each range, and the ranges' last and first rows with
    their texts."""
    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("hash")]
    ranges = plain.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            for b in byte_slices(batch, 1, 1_000_000):
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                rows = [*zip(ids, texts, signatures([t.encode() for t in texts]))]
                if last is None:
                    yield end_row(FIRST, part, *rows[0])
                else:
                    rows.insert(0, last)
                yield edit_rows([(part, *a, *b[1:]) for a, b in zip(rows, rows[1:])])
                last = rows[-1]
        if last is not None:
            yield end_row(LAST, part, *last)

    return ranges.select("doc_id", "text").mapInArrow(run, FIELDS)


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row of
    ``docs(doc_id, text)``: the text with its last third replaced by the beginning of the next document, and how like the
    text's fingerprint is to the edited text's and to the next document's."""
    spark = docs.sparkSession
    rows = Stages(spark, "fingerprint").keep(neighbours(docs))
    # the ranges that hold rows, in their order; the one after the last is the first
    parts = sorted(r["part"] for r in rows.where(F.col("kind") == FIRST).select("part").collect())
    follows = spark.createDataFrame([*zip(parts, [*parts[1:], *parts[:1]])], "part long, next_part long")
    first = rows.where(F.col("kind") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    last = rows.where(F.col("kind") == LAST).select("part", "doc_id", "text", "fingerprint").join(follows, "part").join(first, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2, 1_000_000):
                yield edit_rows([*zip(*(c.to_pylist() for c in b.columns))])

    closed = last.select("part", "doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(finish, FIELDS)
    return rows.where(F.col("kind") == DONE).unionByName(closed).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
