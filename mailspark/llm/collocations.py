"""Phrases of two to four words that stand together more often than their parts (operator 12).

Texts are split into pieces at marks and line ends, pieces into words at blanks and tabs; letters A to Z count as lower
case. Every word begins one window: itself and the three words after it in its piece, padded where the piece ends. Lead
columns (the words' numbers shifted by one, two, three) make the windows of a slice of texts at once, and only the padded
windows of four are counted. Spark's ROLLUP over (lang, w1, w2, w3, w4) then sums the windows' counts into those of all their
prefixes: every phrase of up to four words is the prefix of exactly the windows that begin at its occurrences, and the first
level is the number of words of a language. No n-gram is ever exploded on its own.

Most windows are rare and would only be carried to be summed away. A pass before counts occurrences of 1- to 4-word phrases in
``2 ** sketch_bits`` cells (by a hash of language and words; a cell is never less than the count of any phrase in it). A
window is padded from its first prefix on whose cell stays below ``least``: such a prefix, and all longer ones, occur fewer
than ``least`` times and can be no candidate and no part of one. So counts of ``least`` and more are exact whatever the
number of cells; fewer cells only let more rare windows through. The sketch is 2 ** (sketch_bits - 3) bytes, a fixed size.

Scores, the lowest cut and the containment rule are joins over the phrases of ``least`` or more occurrences; products are
decimals, as they pass 64 bits. The first ``top`` of each language are taken in two steps, hashed parts first, so that no
task sees a whole language.

Null text counts as empty. A null language counts as ``und``, together with that value. Rows that repeat a text count each.
Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import Stages, byte_slices, mix64, tidy

#: The marks and line ends that end a piece. Words are what lies between blanks and tabs.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
ENDS = re.compile(f"[{PIECE_ENDS}]")
TOKEN = re.compile(f"[{PIECE_ENDS}]|[^ \t{PIECE_ENDS}]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
WORDS = ["w1", "w2", "w3", "w4"]
#: Windows, cells or rows of a slice that are worked on together.
STRIDE = 1 << 16


@dataclass(frozen=True)
class Phrases:
    """``least``: occurrences of a candidate. ``scale``: of the score. ``contained``: percent of a phrase's occurrences that a
    longer one must have to replace it. ``top``: phrases a language. ``slice_bytes``: texts counted together in a task."""

    least: int = 30
    scale: int = 2_000_000
    contained: int = 80
    top: int = 2000
    sketch_bits: int = 26
    block_bits: int = 16
    slice_bytes: int = 5_000_000


def segments(text: str, least: int = 1_000_000) -> Iterator[str]:
    """A long text in parts that end with pieces, so that its words never lie in memory together."""
    lo = 0
    while lo < len(text):
        end = ENDS.search(text, lo + least) if len(text) - lo > least else None
        hi = end.end() if end else len(text)
        yield text[lo:hi]
        lo = hi


def numbered(texts: list[str | None], langs: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, list[str]]:
    """The texts' words as numbers, 0 between pieces, and what the numbers stand for; the language of each as a number, and
    what those stand for."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    ends = [number[m] for m in PIECE_ENDS]
    find, many, parts = TOKEN.findall, [], array("i")
    for t in texts:
        # bytes are folded in their ASCII letters alone
        ids = [i for x in segments(t) for i in map(number.__getitem__, find(x.encode().lower().decode()))] if t else []
        ids.append(0)
        parts.extend(ids)
        many.append(len(ids))
    number.default_factory = None  # it refers to the dictionary itself, whose words would stay until the next full garbage collection
    kinds = sorted(set(langs))
    place = {x: k for k, x in enumerate(kinds)}
    lang = np.repeat(np.array([place[x] for x in langs], np.int32), many)
    # all ends of pieces become number 0
    return np.maximum(np.frombuffer(parts, np.int32) - np.int32(ends[-1]), 0), list(number)[ends[-1] :], lang, kinds


def windows(ids: np.ndarray) -> np.ndarray:
    """Four lead columns, one row a word: the numbers of the word and the next three of its piece, 0 where it has ended."""
    n = len(ids)
    lead = np.zeros((4, n), np.int32)
    lead[0] = ids
    for k in range(1, 4):
        if n > k:
            lead[k, : n - k] = ids[k:]
            lead[k][lead[k - 1] == 0] = 0
    return lead


def prefix_cells(lead: np.ndarray, names: list[str], lang: np.ndarray, kinds: list[str], cfg: Phrases) -> Iterator[tuple[int, slice, np.ndarray]]:
    """``(k, rows, cells)``: the sketch cells of the windows' prefixes of k + 1 words, ``STRIDE`` windows at a time; all
    prefixes of some windows come before the next ones."""
    values = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in names], np.uint64)
    first = np.array([xxhash.xxh3_64_intdigest(x.encode(), seed=1) for x in kinds], np.uint64)
    for lo in range(0, len(lang), STRIDE):
        rows = slice(lo, lo + STRIDE)
        acc = first[lang[rows]]
        for k in range(4):
            acc = mix64(acc * MULTIPLIER + values[lead[k, rows]])
            yield k, rows, (acc >> np.uint64(64 - cfg.sketch_bits)).astype(np.uint32)


def changes(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the one before, the first row among them."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes. A batch is let go before the next one is read."""
    for batch in batches:
        yield from byte_slices(batch, column, most)
        del batch


def cell_counts(b: pa.RecordBatch, cfg: Phrases) -> Iterator[pa.RecordBatch]:
    """``(block, at, n)`` of a slice ``(lang, text)``: which cells of a block it has, and how often, up to 255."""
    ids, names, lang, kinds = numbered(b.column(1).to_pylist(), b.column(0).to_pylist())
    lead = windows(ids)
    cells, n = np.empty(np.count_nonzero(lead), np.uint32), 0
    for k, rows, cell in prefix_cells(lead, names, lang, kinds, cfg):
        cell = cell[lead[k, rows] > 0]
        cells[n : n + len(cell)] = cell
        n += len(cell)
    del ids, names, lang, lead
    cells.sort()
    block, lo = 1 << cfg.block_bits, 0
    while lo < len(cells):
        # some cells at a time, up to the end of a block
        last = int(cells[min(lo + STRIDE, len(cells)) - 1]) >> cfg.block_bits
        hi = int(np.searchsorted(cells, np.uint64((last + 1) << cfg.block_bits)))
        new = changes(cells[lo:hi])
        often = np.minimum(np.diff(new, append=hi - lo), 255).astype(np.uint8)
        some = cells[lo:hi][new]
        own = some >> np.uint32(cfg.block_bits)
        first = changes(own)
        low = (some & np.uint32(block - 1)).astype(np.uint16)
        ends = [*first[1:].tolist(), len(own)]
        at = [low[i:j].tobytes() for i, j in zip(first.tolist(), ends)]
        n = [often[i:j].tobytes() for i, j in zip(first.tolist(), ends)]
        yield pa.RecordBatch.from_arrays([pa.array(own[first].astype(np.int32)), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["block", "at", "n"])
        lo = hi


def padded_windows(b: pa.RecordBatch, often: np.ndarray, cfg: Phrases) -> Iterator[pa.RecordBatch]:
    """``(lang, w1, w2, w3, w4, c)`` of a slice ``(lang, text)``, ``STRIDE`` rows at a time."""
    ids, names, lang, kinds = numbered(b.column(1).to_pylist(), b.column(0).to_pylist())
    lead = windows(ids)
    for k, rows, cell in prefix_cells(lead, names, lang, kinds, cfg):
        keep = (keep if k else True) & ((often[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8)) & 1 == 1)
        lead[k, rows][~keep] = 0
    word, words = ids > 0, pa.array([None, *names[1:]], pa.string())
    del ids, names
    low = np.uint64(0xFFFFFFFF)
    for x in range(len(kinds)):
        own = np.flatnonzero(word & (lang == x))
        # two keys a window; padding is 0 from some word on
        left, right = (lead[k, own].astype(np.uint64) << np.uint64(32) | lead[k + 1, own].astype(np.uint64) for k in (0, 2))
        del own
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        del order
        new = changes(left, right)
        c = np.diff(new, append=len(left))
        left, right = left[new], right[new]
        del new
        for lo in range(0, len(c), STRIDE):
            p, q = left[lo : lo + STRIDE], right[lo : lo + STRIDE]
            cols = [words.take(pa.array(v.astype(np.int64))) for v in (p >> np.uint64(32), p & low, q >> np.uint64(32), q & low)]
            yield pa.RecordBatch.from_arrays([pa.array([kinds[x]] * len(p), pa.string()), *cols, pa.array(c[lo : lo + STRIDE])], ["lang", *WORDS, "c"])


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))


def sketch(docs: DataFrame, cfg: Phrases) -> DataFrame:
    """``(block, bits)``: which cells of a block of the sketch hold ``least`` or more occurrences, as a bit map."""
    block = 1 << cfg.block_bits

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return chain.from_iterable(map(lambda b: cell_counts(b, cfg), text_slices(batches, 1, cfg.slice_bytes)))

    @tidy
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for key, at, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                held = sums.get(key)
                if held is None:
                    held = sums[key] = np.zeros(block, np.uint8)
                at = np.frombuffer(at.as_buffer(), np.uint16)
                held[at] = np.minimum(held[at].astype(np.uint16) + np.frombuffer(n.as_buffer(), np.uint8), 255)
        bits = [np.packbits(x >= cfg.least).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["block", "bits"])

    parts = plain(docs).mapInArrow(count, "block int, at binary, n binary")
    return parts.repartition("block").mapInArrow(total, "block int, bits binary")


def window_counts(docs: DataFrame, cells: bytes, cfg: Phrases) -> DataFrame:
    """``(lang, w1, w2, w3, w4, c)``: counts of padded windows, a slice of texts each; null is padding."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(cells, np.uint8)
        return chain.from_iterable(map(lambda b: padded_windows(b, often, cfg), text_slices(batches, 1, cfg.slice_bytes)))

    return plain(docs).mapInArrow(run, "lang string, w1 string, w2 string, w3 string, w4 string, c long")


def phrase_counts(docs: DataFrame, cfg: Phrases, stages: Stages) -> DataFrame:
    """``(lang, size, phrase, f)``: how often each phrase of 1 to 4 words that occurs ``least`` times or more occurs, and for
    size 0 how many words a language has."""
    blocks = {r["block"]: bytes(r["bits"]) for r in sketch(docs, cfg).collect()}  # 2 ** sketch_bits bits at most
    none = bytes(1 << (cfg.block_bits - 3))
    cells = b"".join(blocks.get(k, none) for k in range(1 << (cfg.sketch_bits - cfg.block_bits)))
    summed = window_counts(docs, cells, cfg).rollup("lang", *WORDS).agg(F.sum("c").alias("f"), F.grouping_id().alias("level"))
    # grouping_id has one bit set for each column summed away
    size = F.lit(4) - F.expr("bit_count(level)")
    last = F.when(size == 0, F.lit("")).otherwise(F.element_at(F.array(*WORDS), F.greatest(size, F.lit(1)).cast("int")))
    found = summed.where(F.col("lang").isNotNull() & (size >= 0) & last.isNotNull() & ((size == 0) | (F.col("f") >= cfg.least)))
    return stages.keep(found.select("lang", size.cast("int").alias("size"), F.concat_ws(" ", *WORDS).alias("phrase"), "f"))


def wide(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(20,0)")


def part(words: Column, first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(counts: DataFrame, cfg: Phrases) -> DataFrame:
    """``(lang, phrase, size, a, l, r, score)``: candidates with the parts of their lowest cut."""
    phrases = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", part(F.col("words"), 1, F.col("k")).alias("p"), part(F.col("words"), F.col("k") + 1, F.col("size")).alias("q"))
    known = counts.where("size between 1 and 3")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("p"), F.col("f").alias("l")), ["lang", "p"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("q"), F.col("f").alias("r")), ["lang", "q"])
    cuts = cuts.withColumn("whole", wide("a") * F.lit(cfg.scale)).withColumn("sides", wide("l") + wide("r"))
    cut = F.struct(F.expr("whole div sides").alias("score"), "k", "l", "r")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(cut).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def contained(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, longer)``: the largest count of a longer phrase that holds a phrase's words in a row."""
    longer = counts.where("size > 2").select("lang", "size", "f", F.split("phrase", " ").alias("words"))
    spans = longer.select("lang", "size", "f", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n"))
    spans = spans.select("lang", "f", "words", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    return spans.select("lang", part(F.col("words"), F.col("at"), F.col("n")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, cfg: Phrases = Phrases()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of ``docs(text, lang)``."""
    stages = Stages(docs.sparkSession, "collocations")
    counts = phrase_counts(docs, cfg, stages)
    held = scored(counts, cfg).join(contained(counts), ["lang", "phrase"], "left")
    kept = held.where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * F.lit(cfg.contained)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = kept.withColumn("place", F.row_number().over(share)).where(F.col("place") <= cfg.top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= cfg.top)
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return first.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
