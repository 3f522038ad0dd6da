"""Packing documents into training windows by non-negative least squares (operator 9).

Every document becomes token ids and an end id, cut at multiples of the window; a cut's remainder is a piece. Piece lengths
are rounded up to bins. All combinations of up to ``depth`` bins that fill a window exactly are enumerated; repeat counts
for them are the non-negative least-squares solution against the corpus's histogram of bins, rounded down. What they leave
is packed greedily, longest first, again as combinations with repeat counts. So a plan is a short list of combinations,
whatever the corpus's size, and needs the histogram alone on the driver (one count per bin).

Pieces take their places by rank: the r-th piece of a bin belongs to a known combination, copy and slot. Ranks within a
bin are taken in hashed parts of some ten thousand pieces with the parts' counts summed before, so a length that a third of
all documents share costs no task more than a part. Tokenising is one narrow pass; ids never move, their CRC is taken
where they are made. Splitting at ASCII blanks first changes no id, as the tokenizer drops blanks and no token crosses
them; lower-cased words are remembered in a bounded cache, apart from the marks that follow them.

Null text counts as empty: one piece, the end id alone. Repeated rows are packed each. Empty table: no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import Stages, byte_slices, tidy


@dataclass(frozen=True)
class PackConfig:
    tokenizer: str
    window: int = 2048
    end_id: int = 1
    bin: int = 8
    depth: int = 3
    part_rows: int = 20_000
    words: int = 200_000


MARK = re.compile(rb"[!-/:-@\[-`{-~](?<=[a-z].)", re.DOTALL)  # an ASCII mark after a letter
WIDE = re.compile("[\u0130\u0250-\U0010ffff]")  # below these, lower-casing goes letter by letter and NFC changes nothing


class WordIds:
    """``ids``: word (bytes) -> its ids as little-endian 32-bit bytes; two generations of at most ``limit`` words.

    ``split`` cuts a text at blanks and between a letter and an ASCII mark, where the tokenizer always cuts, and lower-cases
    it as the tokenizer would, so that few words differ. Words of letters alone are encoded many at once, blanks between:
    each is then one run of ids up to an id that ends a word. Where the counts don't agree, and for all other words, each is
    encoded alone."""

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        added = [t for _, t in sorted(self.tokenizer.get_added_tokens_decoder().items())]
        self.special = [t.content.encode().lower() for t in added]
        # for lower-case letters, which the tokenizer's normaliser and cutter leave as they are; both share one model
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.add_special_tokens([t for t in added if t.special])
        self.plain.add_tokens([t for t in added if not t.special])
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def split(self, text: str) -> list[bytes]:
        """The words of ``text``; a text that holds a special token, in any case, is cut at blanks alone."""
        data = (text if text.isascii() or WIDE.search(text) else text.lower()).encode()
        low = data.lower()
        if any(map(low.__contains__, self.special)):
            return text.encode().split()
        return MARK.sub(rb" \g<0>", low).split()

    def unknown(self, words: set) -> set:
        """Those of ``words`` that neither generation knows; what the old one knows moves to the new."""
        new = words.difference(self.ids)
        never = new.difference(self.old)
        again = new - never
        self.ids.update(zip(again, map(self.old.__getitem__, again)))
        return never

    def learn(self, words: set) -> None:
        """Makes all of ``words`` known; what is new is encoded in batches."""
        if len(self.ids) + len(words) > self.limit:
            self.old, self.ids = self.ids, {}
        plain, letters, others = [], [], []
        for w in self.unknown(words):
            if w.isalpha() and w.islower():
                plain.append(w)
            elif w.isascii():
                others.append(w)
            else:
                s = w.decode()
                if s.isalpha() and not WIDE.search(s) and s == s.lower():
                    plain.append(w)
                else:
                    (letters if unicodedata.normalize("NFC", s).lower().isalpha() else others).append(w)
        self.encode(others)
        for tokenizer, some in ((self.plain, plain), (self.tokenizer, letters)):
            for at in range(0, len(some), 1000):
                self.encode_letters(tokenizer, some[at : at + 1000])

    def encode(self, words: list) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)):
            self.ids[w] = np.array(e.ids, "<u4").tobytes()

    def encode_letters(self, tokenizer, words: list) -> None:
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(words):
            return self.encode(words)
        data, stops = ids.tobytes(), (4 * ends + 4).tolist()
        self.ids.update((w, data[lo:hi]) for w, lo, hi in zip(words, [0, *stops], stops))


def word_ids(path: str, limit: int) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path, limit)


def pieces(docs: DataFrame, cfg: PackConfig, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens[, ids])``: one row per piece."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(cfg.tokenizer, cfg.words)
        end = np.array([cfg.end_id], "<u4").tobytes()
        step = 4 * cfg.window
        for batch in batches:
            for b in byte_slices(batch, 1, 500_000):
                split = [known.split(t) if t else [] for t in b.column(1).to_pylist()]
                known.learn(set().union(*split))
                which, start, length, crc, total, ids = [], [], [], [], [], []
                for i, words in enumerate(split):
                    data = b"".join(map(known.ids.__getitem__, words)) + end
                    for at in range(0, len(data), step):
                        part = data[at : at + step]
                        which.append(i)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(len(data) // 4)
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                cols = [b.column(0).take(pa.array(which, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def combinations(full: int, depth: int, present: set[int]) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` present bins that sum to ``full``."""
    out = [(full,)] if full in present else []
    low = sorted(present)
    for d in range(2, depth + 1):
        for head in combinations_with_replacement(low, d - 1):
            last = full - sum(head)
            if last >= head[-1] and last in present:
                out.append((*head, last))
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares by active sets: variables enter by the steepest gradient, and leave on reaching zero."""
    gram, rhs = a.T @ a, a.T @ b
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(rhs).max(initial=0))
    for _ in range(4 * a.shape[0] + 20):
        slope = rhs - gram @ x
        slope[active] = -np.inf
        enter = int(np.argmax(slope)) if n else -1
        if enter < 0 or slope[enter] <= tolerance:
            break
        active[enter] = True
        while True:
            on = np.flatnonzero(active)
            trial = np.linalg.lstsq(gram[np.ix_(on, on)], rhs[on], rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[on] = trial
                break
            sinking = trial <= 0
            now = x[on]
            step = np.min(now[sinking] / np.maximum(now[sinking] - trial[sinking], 1e-300))
            x[on] = now + step * (trial - now)
            gone = on[(x[on] <= 1e-12 * max(1.0, x.max())) & sinking]
            gone = gone if len(gone) else on[sinking][:1]
            x[gone] = 0
            active[gone] = False
    return x


def plan(counts: dict[int, int], full: int, depth: int) -> list[tuple[dict[int, int], int]]:
    """Combinations (bin -> how many) and their repeats, which use up ``counts`` exactly."""
    left = {b: n for b, n in counts.items() if n > 0}
    out = []
    if left.get(full):
        out.append(({full: 1}, left.pop(full)))
    ways = combinations(full, depth, set(left))
    if ways:
        bins = sorted(left)
        row = {b: i for i, b in enumerate(bins)}
        a = np.zeros((len(bins), len(ways)))
        for j, way in enumerate(ways):
            for b in way:
                a[row[b], j] += 1
        for j in np.argsort(-(x := nnls(a, np.array([left[b] for b in bins], float))), kind="stable"):
            uses = {b: ways[j].count(b) for b in set(ways[j])}
            repeats = min(int(x[j] + 1e-6), *(left[b] // m for b, m in uses.items()))
            if x[j] < 1:
                break
            if repeats > 0:
                out.append((uses, repeats))
                for b, m in uses.items():
                    left[b] -= m * repeats
    while left := {b: n for b, n in left.items() if n > 0}:
        room, uses = full, {}
        for b in sorted(left, reverse=True):
            if m := min(room // b, left[b]):
                uses[b] = m
                room -= m * b
        repeats = min(left[b] // m for b, m in uses.items())
        out.append((uses, repeats))
        for b, m in uses.items():
            left[b] -= m * repeats
    return out


def pack(docs: DataFrame, cfg: PackConfig) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: one row per piece of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    stages = Stages(spark, "packing")
    bin_ = F.ceil(F.col("length") / cfg.bin).cast("int")
    cut = stages.keep(pieces(docs, cfg).select("*", bin_.alias("bin"), F.monotonically_increasing_id().alias("row")))
    counts = {r["bin"]: r["count"] for r in cut.groupBy("bin").count().collect()}  # at most window / bin rows
    full = cfg.window // cfg.bin
    used = dict.fromkeys(counts, 0)
    places, base = [], 0
    for uses, repeats in plan(counts, full, cfg.depth):
        for b, m in uses.items():
            places.append((b, used[b], used[b] + m * repeats, base, repeats))
            used[b] += m * repeats
        base += repeats
    parts = F.create_map(*(F.lit(v) for b, n in sorted(counts.items()) for v in (b, -(-n // cfg.part_rows)))) if counts else F.create_map(F.lit(0), F.lit(1))
    part = F.pmod(F.xxhash64("doc_id", "start", "row"), F.coalesce(F.element_at(parts, F.col("bin")), F.lit(1))).alias("part")
    dealt = cut.select("*", part)
    sizes = dealt.groupBy("bin", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = stages.keep(sizes.select("bin", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("at")))
    inside = Window.partitionBy("bin", "part").orderBy("doc_id", "start", "row")
    ranked = dealt.withColumn("in_part", F.row_number().over(inside) - 1).join(at, ["bin", "part"]).withColumn("rank", F.col("at") + F.col("in_part"))
    # broadcast: a plan has a few hundred combinations of at most window / bin bins, whatever the corpus
    where = spark.createDataFrame(places, "place_bin int, lo long, hi long, base long, repeats long")
    seated = ranked.join(F.broadcast(where), (F.col("bin") == F.col("place_bin")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    seated = seated.withColumn("sequence_id", F.col("base") + F.pmod(F.col("rank") - F.col("lo"), F.col("repeats")))
    along = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "row").rowsBetween(Window.unboundedPreceding, -1)
    return seated.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("long").alias("offset"))


def sequences(docs: DataFrame, packed: DataFrame, cfg: PackConfig, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids, doc_ids, starts)``: the windows themselves, from ``pack``'s rows. Windows are padded to full
    length, except where the ids' number is a power of two. Rows that repeat a document take its pieces' places in turn."""
    key = ["doc_id", "start", "length", "ids_crc32"]
    turn = lambda df, by: df.withColumn("_turn", F.row_number().over(Window.partitionBy(*key).orderBy(by)))
    made = turn(pieces(docs, cfg, with_ids=True).select(*key, "ids"), F.lit(0))
    seats = turn(packed.select(*key, "sequence_id", "offset"), F.struct("sequence_id", "offset"))
    right = made.select(*(F.col(c).alias(f"_{c}") for c in [*key, "_turn"]), "ids")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*key, "_turn"]]
    rows = seats.join(right, on).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    short = F.lit(cfg.window) - F.size("ids")
    power = F.pow(F.lit(2.0), F.floor(F.log2(F.size("ids").cast("double")))).cast("int") == F.size("ids")
    rows = rows.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("p", lambda x: x["offset"]).alias("starts"))
    return rows.withColumn("ids", F.when(power, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), short))))
