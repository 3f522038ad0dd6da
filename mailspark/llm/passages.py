"""Repeated passages by sliding spans of sentences (operator 10).

Texts are cut between words (as ``split()`` sees them) into sentences, at ``.``, ``!``, ``?`` and line ends. A sentence of
more than ``whole`` words is divided into parts of ``shortest`` to ``longest`` words, so that a passage inside of it can be
told from what stands around it: a cut lies where the key of two neighbouring words is the smallest within ``shortest`` - 1
words on either side, ends of sentences being smaller than all other places; a stretch of more than ``longest`` words between
such cuts is cut from its left at the smallest key that is ``shortest`` to ``longest`` words on. A cut thus depends on the words
around it alone. Sentences and parts are the units.

From every unit on, the run of at least ``run`` consecutive units and ``least_words`` words is hashed (case and blanks folded),
so short sentences come together until they hold enough words; the last units of a text begin none (of many short ones, the
last few words may lie in no run). Runs are joined by
hash over the whole corpus: the smallest (doc_id, text CRC, place) of a repeated run is its first, and units covered by any
other are removed whole.

The runs are written once. Their first places are aggregated before the shuffle, and the join that finds the others is a
plain shuffle join, so a passage that a third of all documents share is split. Per document only the places of its own
runs come together. Documents whose (doc_id, CRC) falls in a cell of a fixed number of cells (``cells``, broadcast) where one
loses something meet their places in a shuffle join; all others stay where they are and are not cut again. More documents
than cells only send more of them through the join.

Null or empty text: no unit, unchanged. Rows that repeat doc_id and text count as one document and get the same result.
A null doc_id counts as smaller than all others. Extra columns, whatever their names, are ignored (``repeated_passages``) or
kept (``without_repeats``).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import MASK, Cache, Stages, byte_slices, free_memory, mix64, tidy

WORD = re.compile(r"\S+\s*")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Where sentences are told apart for counting them.
SENTENCE_END = "(?<=[.!?])[ \\t\\n]+|\\n+"


@dataclass(frozen=True)
class Spans:
    run: int = 3
    least_words: int = 20
    whole: int = 12
    shortest: int = 4
    longest: int = 8
    cells: int = 1 << 20
    cached: int = 50_000  # words whose hashes a task remembers (twice as many at most)


def word_value(word: str) -> int:
    """Hash of a word with the blanks after it folded; its lowest bit is 0 at the end of a sentence."""
    bare = word.strip()
    inside = bare[-1] not in ".!?" and "\n" not in word[len(word.rstrip()) :]
    return xxhash.xxh3_64_intdigest(bare.lower(), seed=1) & ~1 | inside


def picker(cfg: Spans) -> Cache:
    return Cache(word_value, cfg.cached)


def words_of(text: str) -> list[str]:
    """The words with the blanks after them, the first also with those before it."""
    words = WORD.findall(text)
    if words:
        words[0] = text[: len(text) - len(text.lstrip())] + words[0]
    return words


def units(values: np.ndarray, cfg: Spans) -> np.ndarray:
    """Numbers of the words that units begin with, and last the number of words."""
    n, least = len(values), cfg.shortest
    if n < 2:
        return np.arange(n + 1)
    ends = np.flatnonzero(values[:-1] & np.uint64(1) == 0) + 1
    sentences = np.concatenate([[0], ends, [n]])
    sizes = np.diff(sentences)
    if not (sizes > cfg.whole).any():
        return sentences
    h = values >> np.uint64(1)
    key = (mix64(h[:-1] * MULTIPLIER + h[1:]) >> np.uint64(1)) | ((values[:-1] & np.uint64(1)) << np.uint64(63))
    # key[i] belongs to the place after word i
    pad = np.full(least - 1, MASK)
    wide, smallest = np.concatenate([pad, key, pad]), np.ones(n - 1, bool)
    for k in range(1, least):
        smallest &= (key < wide[least - 1 - k :][: n - 1]) & (key <= wide[least - 1 + k :][: n - 1])
    divided = np.repeat(sizes > cfg.whole, sizes)
    at = np.flatnonzero(smallest & divided[:-1]) + 1
    # the text's own ends are ends of sentences, too
    at = np.union1d(sentences, at[(at >= least) & (at <= n - least)])
    far = np.flatnonzero((np.diff(at) > cfg.longest) & divided[at[:-1]])
    more = []
    for last, b in zip(at[far].tolist(), at[far + 1].tolist()):
        while b - last > cfg.longest:
            low = last + least
            last = low + int(np.argmin(key[low - 1 : min(last + cfg.longest, b - least)]))
            more.append(last)
    return np.union1d(at, more).astype(np.int64) if more else at


def run_ends(at: np.ndarray, cfg: Spans) -> np.ndarray:
    """For each unit that begins a run, the number of the unit after the run."""
    many = len(at) - 1
    if many < cfg.run:
        return np.empty(0, np.int64)
    ends = np.maximum(np.searchsorted(at, at[:-1] + cfg.least_words), np.arange(many) + cfg.run)
    return ends[ends <= many]


def values_of(words: list[str], picked: Cache) -> np.ndarray:
    return np.fromiter(map(picked.__getitem__, words), np.uint64, len(words))


def sentences(text: str, cfg: Spans, picked: Cache) -> list[str]:
    """The text in units that join to it again."""
    words = words_of(text)
    if not words:
        return [text]
    at = units(values_of(words, picked), cfg).tolist()
    return ["".join(words[a:b]) for a, b in zip(at, at[1:])]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, ``n`` at least."""
    if len(_POWERS[0]) < n:
        more = 1 << n.bit_length()
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(more, x, np.uint64))]) for x in (MULTIPLIER, INVERSE)]
    return _POWERS[0], _POWERS[1]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def hashed_runs(text: str, cfg: Spans, picked: Cache) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs, and the number of each one's first unit."""
    values = values_of(words_of(text), picked)
    at = units(values, cfg)
    ends = run_ends(at, cfg)
    first = np.arange(len(ends), dtype=np.int32)
    if not len(ends):
        return np.empty(0, np.uint64), first
    inside = (np.arange(len(values)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
    h = np.add.reduceat(mix64((values >> np.uint64(1)) + inside * MULTIPLIER), at[:-1])
    up, down = powers(len(h))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h) * up[: len(h)], dtype=np.uint64)])
    return mix64((sums[ends] - sums[first]) * down[first] + (ends - first).astype(np.uint64)), first


def all_runs(docs: DataFrame, cfg: Spans) -> DataFrame:
    """``(h, doc_id, crc, at)``; ``at`` counts units."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked = picker(cfg)
        for batch in batches:
            for b in byte_slices(batch, 1, 1_000_000):
                hs, ats, n, crc = [], [], [], []
                for t in b.column(1).to_pylist():
                    h, at = hashed_runs(t, cfg, picked) if t else (np.empty(0, np.uint64), np.empty(0, np.int32))
                    hs.append(h)
                    ats.append(at)
                    n.append(len(h))
                    crc.append(zlib.crc32(t.encode()) if t else 0)
                doc = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs).view(np.int64)), b.column(0).take(pa.array(doc)), pa.array(np.repeat(np.array(crc, np.int64), n)), pa.array(np.concatenate(ats))],
                    ["h", "doc_id", "crc", "at"],
                )

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "h long, doc_id long, crc long, at int")


def non_first(docs: DataFrame, cfg: Spans, stages: Stages) -> DataFrame:
    """``(doc_id, crc, starts)``: per document the first pieces of its non-first repeated runs."""
    runs = stages.keep(all_runs(docs, cfg))
    place = F.struct("doc_id", "crc", "at")
    # rows that repeat a document repeat its places, so what counts is whether places differ
    firsts = runs.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("h", "first")
    firsts = stages.keep(firsts)
    again = runs.join(firsts, "h").where(~place.eqNullSafe(F.col("first")))
    return again.groupBy("doc_id", "crc").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def cell(doc_id: Column, crc: Column, cfg: Spans) -> Column:
    return F.pmod(F.xxhash64(doc_id, crc), F.lit(cfg.cells)).cast("int")


def parted(docs: DataFrame, cfg: Spans) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as structs ``row``: those that lose nothing, and others ``(row, starts)``, whose ``starts`` are null
    if they lose nothing after all."""
    stages = Stages(docs.sparkSession, "passages")
    found = stages.keep(non_first(docs, cfg, stages))
    crc = F.coalesce(F.crc32(F.encode(F.col("row.text").cast("string"), "UTF-8")), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), crc.alias("crc"))
    rows = rows.withColumn("cell", cell(F.col("doc_id"), F.col("crc"), cfg))
    hit = F.broadcast(found.select(cell(F.col("doc_id"), F.col("crc"), cfg).alias("cell")).distinct())  # ``cells`` numbers at most
    quiet = rows.join(hit, "cell", "left_anti").select("row")
    places = found.select(F.col("doc_id").alias("d"), F.col("crc").alias("c"), "starts")
    touched = rows.join(hit, "cell", "left_semi").join(places, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("crc") == F.col("c")), "left")
    return quiet, touched.select("row", "starts")


def cleaned(text: str | None, starts, cfg: Spans, picked: Cache) -> tuple[str | None, int, str]:
    """The text without covered units, how many it lost, and the removed stretches."""
    if not text or starts is None or not len(starts):
        return text, 0, ""
    words = words_of(text)
    at = units(values_of(words, picked), cfg)
    ends = run_ends(at, cfg)
    gone = np.zeros(len(at), np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, ends[starts], -1)
    gone = np.cumsum(gone)[:-1] > 0
    out, cut, place = [], [], 0
    for a, b, lost in zip(at.tolist(), at[1:].tolist(), gone.tolist()):
        unit = "".join(words[a:b])
        if lost:
            if cut and cut[-1][1] == place:
                cut[-1][1] = place + len(unit)
            else:
                cut.append([place, place + len(unit)])
        else:
            out.append(unit)
        place += len(unit)
    return "".join(out), int(gone.sum()), ",".join(f"{a}:{b}" for a, b in cut)


def sentence_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), SENTENCE_END)
    return F.size(F.filter(parts, lambda x: x.rlike("[^ \\t\\n]"))).cast("long")


def repeated_passages(docs: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """``(doc_id, n_sentences, n_removed, removed, text)`` for every row of ``docs(doc_id, text)``: ``n_removed`` counts units,
    ``removed`` lists start:end in code points, ``text`` is what is left."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked = picker(cfg)
        for batch in batches:
            for b in byte_slices(batch, 2, 1_000_000):
                rows = [cleaned(t, s, cfg, picked) for t, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                text, gone, cut = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(gone, pa.int64()), pa.array(cut, pa.string()), pa.array(text, pa.string())],
                    ["doc_id", "n_sentences", "n_removed", "removed", "text"],
                )

    quiet, touched = parted(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cfg)
    own = [F.col("row.doc_id").alias("doc_id"), sentence_count(F.col("row.text")).alias("n_sentences")]
    changed = touched.select(*own, F.col("row.text").alias("text"), "starts")
    none = [F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("removed")]
    return quiet.select(*own, *none, F.col("row.text").alias("text")).unionByName(
        changed.mapInArrow(run, "doc_id long, n_sentences long, n_removed long, removed string, text string")
    )


def without_repeats(docs: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """``docs`` with repeated units removed from ``text`` and ``n_chars``, where there is one, counted anew. A document
    that loses all its words goes; all others stay, with all columns."""

    @F.pandas_udf("string")
    def left(text: pd.Series, starts: pd.Series) -> pd.Series:
        free_memory()
        picked = picker(cfg)
        return pd.Series([cleaned(t, s, cfg, picked)[0] for t, s in zip(text, starts)], dtype=object)

    quiet, touched = parted(docs, cfg)
    new = F.when(F.col("starts").isNotNull(), left(F.col("row.text").cast("string"), F.col("starts")))
    rows = touched.select("row", "starts", new.alias("new")).where(F.col("starts").isNull() | F.col("new").rlike(r"\S"))
    kinds = dict(docs.dtypes)
    changed = {"text": F.col("new").cast(kinds["text"])}
    if "n_chars" in kinds:
        changed["n_chars"] = F.length("new").cast(kinds["n_chars"])
    old = {c: F.col("row").getField(c) for c in docs.columns}
    # a changed text is of a row that has places
    value = {c: F.when(F.col("starts").isNull(), v).otherwise(changed[c]) if c in changed else v for c, v in old.items()}
    return quiet.select(*[v.alias(c) for c, v in old.items()]).unionByName(rows.select(*[v.alias(c) for c, v in value.items()]))
