"""Near-duplicate documents by min-max hashing (operator 2).

A document's set holds its distinct k-word shingles. Every permutation gives two signature values, the smallest and
the largest image, so 64 evaluations give 128 values; four in a row (of four different permutations) form a band, and
documents that share a band are candidates. With J the similarity, a pair is missed with probability
``(1 - J^4)^32``: 6e-11 at 0.85, 5e-8 at 0.8. Every link is confirmed on the full sets.

Copies are folded first: documents with equal sets (128-bit fingerprint and size) are one member, named by a 64-bit hash of
these; its set is made from the text of its first row (smallest doc_id, null last, then the text's hash). Then stars: in each of
its bands a member is compared with a few drawn centres, not with all. Few bands still hold several components after
that; there, pairs of different components are looked at inside the join, and those
come out whose sizes and odd sketches allow a link. An odd sketch has one bit for every cell, set where an odd number of the
set's shingles fall; every shingle that only one of two sets holds flips one bit, so sketches never differ in more bits than the
sets differ in shingles. The test therefore loses no link, and it lets hardly any other pair through: in 512 cells few of
the differences of short texts meet, and sets of over ``short`` shingles have a second sketch of ``wide`` cells. First every
member of such a band meets a few members drawn for this band, and what links is contracted; then the pairs of components that
are still different. All are confirmed on full sets, so no link between different texts is lost and no group's pairs are listed.

Results: documents with null or empty text, or without a word, have the empty set and link with nothing. Fewer than k
words: the whole sequence is one shingle. A component is named by its smallest doc_id and keeps its first
row: rows that repeat a doc_id with other texts, or have a null one, are judged by their own texts. A group with null doc_ids
alone is named null and keeps one. Extra columns are ignored (``near_duplicates``) or kept (``drop_near_duplicates``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Cache, Stages, byte_slices, components, mix64, starts, tidy


@dataclass(frozen=True)
class MinMax:
    shingle: int = 5
    percent: int = 80  # link when 100 * intersection >= percent * union
    bands: int = 32
    rows: int = 4
    seed: int = 20_250_101
    centres: int = 4
    sketch: int = 512
    short: int = 0
    wide: int = 4096


def shingle_sets(texts: list, k: int, words: Cache) -> list[np.ndarray]:
    """The sorted 64-bit shingle hashes of each text. Case is folded for A-Z alone, as bytes.lower() does."""
    out = []
    for t in texts:
        w = t.encode().lower().split() if t else []
        h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
        if 0 < len(h) < k:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=k)], np.uint64))
            continue
        n = max(len(h) - k + 1, 0)
        mixed = np.zeros(n, np.uint64)
        for i in range(k):
            mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        out.append(np.unique(mixed))
    return out


def minmax(flat: np.ndarray, off: np.ndarray, perms: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """Signature values of every set, one permutation's minimum and maximum after the other: (number, value per set). The
    maximum of permutation j has number ``perms + j``. Every set must be non-empty."""
    draw = np.random.default_rng(seed).integers(0, 2**63, (2, perms), np.uint64)
    for j in range(perms):
        x = (flat ^ draw[0, j]) * (draw[1, j] | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= draw[0, j] | np.uint64(1)
        yield j, np.minimum.reduceat(x, off[:-1])
        yield perms + j, np.maximum.reduceat(x, off[:-1])


def band_hashes(flat: np.ndarray, off: np.ndarray, cfg: MinMax) -> np.ndarray:
    """(documents, bands)."""
    n = cfg.bands * cfg.rows
    sig = np.empty((n, len(off) - 1), np.uint64)
    for j, value in minmax(flat, off, n // 2, cfg.seed):
        sig[j] = value
    bands = np.zeros((cfg.bands, len(off) - 1), np.uint64)
    for b in range(cfg.bands):
        acc = np.full(len(off) - 1, b, np.uint64)
        for r in range(cfg.rows):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + sig[b * cfg.rows + r])
        bands[b] = acc
    return bands.T


def int_lists(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts(sizes).astype(np.int32)), pa.array(np.ascontiguousarray(values).ravel().view(np.int64)))


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string")).alias("t")


def signatures(docs: DataFrame, cfg: MinMax) -> DataFrame:
    """``(doc_id, t, n, f1, f2, bands)``: text hash, set size, fingerprint and band hashes (empty for empty sets)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Cache(xxhash.xxh3_64_intdigest)
        for batch in batches:
            for b in byte_slices(batch, 1, 400_000):
                sets = shingle_sets(b.column(1).to_pylist(), cfg.shingle, words)
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                off = starts(size[full])
                flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                none = size == 0
                f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                bands = np.empty(0, np.uint64)
                if len(full):
                    f1[full] = np.add.reduceat(mix64(flat), off[:-1])
                    f2[full] = np.add.reduceat(mix64(flat ^ np.uint64(0x5851F42D4C957F2D)), off[:-1])
                    bands = band_hashes(flat, off, cfg)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(size), pa.array(f1.view(np.int64), mask=none), pa.array(f2.view(np.int64), mask=none), int_lists(np.where(none, 0, cfg.bands), bands)],
                    ["doc_id", "t", "n", "f1", "f2", "bands"],
                )

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash())
    return plain.mapInArrow(run, "doc_id long, t long, n long, f1 long, f2 long, bands array<long>")


def full_sets(docs: DataFrame, cfg: MinMax) -> DataFrame:
    """``(member, shingles)`` of ``docs(member, text)``: the whole set, for confirming."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Cache(xxhash.xxh3_64_intdigest)
        for batch in batches:
            for b in byte_slices(batch, 1, 400_000):
                sets = shingle_sets(b.column(1).to_pylist(), cfg.shingle, words)
                off = starts([len(s) for s in sets]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], ["member", "shingles"])

    return docs.mapInArrow(run, "member long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, cfg: MinMax) -> DataFrame:
    """Those ``pairs(a, b)`` whose full sets are similar enough. Both joins are plain shuffle joins, so Spark may split
    a centre's many pairs."""
    a = sets.select(F.col("member").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("member").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    near = 100 * both >= cfg.percent * (F.size("sa") + F.size("sb") - both)
    return pairs.join(b, "b").join(a, "a").where(near).select("a", "b")


def odd_bits(flat: np.ndarray, off: np.ndarray, cells: int) -> np.ndarray:
    """(sets, cells / 64): one bit a cell, set where an odd number of the set's shingles fall."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    count = np.bincount(row * cells + (mix64(flat) % np.uint64(cells)).astype(np.int64), minlength=(len(off) - 1) * cells)
    return np.packbits((count & 1).astype(np.uint8).reshape(len(off) - 1, cells), axis=1).view(np.int64)


def sketches(sets: DataFrame, cfg: MinMax) -> DataFrame:
    """``(member, sketch, wide)``: odd sketches of full sets, 64 cells in a word; ``wide`` is empty for sets of ``short`` shingles."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                lists = part.column(1)
                off = lists.offsets.to_numpy()
                flat = lists.values.to_numpy().view(np.uint64)[off[0] : off[-1]]
                off = (off - off[0]).astype(np.int64)
                sketch = odd_bits(flat, off, cfg.sketch)
                size = np.diff(off)
                long = size > cfg.short
                wide = odd_bits(flat[np.repeat(long, size)], starts(size[long]), cfg.wide)
                lists = [int_lists(np.full(len(size), sketch.shape[1]), sketch), int_lists(np.where(long, cfg.wide // 64, 0), wide)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["member", "sketch", "wide"])

    return sets.select("member", "shingles").mapInArrow(run, "member long, sketch array<long>, wide array<long>")


def may_link(cfg: MinMax) -> Column:
    """Over columns of both sides: sizes and odd sketches allow a link. Two linked sets of sizes ``na`` and ``nb`` differ in at most
    ``(100 - percent) / (100 + percent) * (na + nb)`` shingles."""
    sizes = 100 * F.least("na", "nb") >= cfg.percent * F.greatest("na", "nb")
    apart = F.lit(0)
    for i in range(cfg.sketch // 64):
        apart = apart + F.bit_count(F.get("ka", F.lit(i)).bitwiseXOR(F.get("kb", F.lit(i))))
    few = lambda n: (100 + cfg.percent) * n <= (100 - cfg.percent) * (F.col("na") + F.col("nb"))
    # a side without a wide sketch leaves nulls, which count as equal
    flips = F.zip_with("wa", "wb", lambda p, q: F.coalesce(F.bit_count(p.bitwiseXOR(q)), F.lit(0)))
    return sizes & few(apart) & few(F.aggregate(flips, F.lit(0), lambda total, x: total + x))


def split_bands(shared: DataFrame, comp: DataFrame, stages: Stages) -> DataFrame:
    """``(no, band, member, comp)`` of the bands of ``shared`` that hold several components of ``comp(node, component)``."""
    at = shared.select("no", "band", "member").join(comp.withColumnRenamed("node", "member"), "member", "left")
    at = stages.keep(at.select("no", "band", "member", F.coalesce("component", "member").alias("comp")))
    split = at.groupBy("no", "band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("no", "band")
    left = stages.keep(at.join(split, ["no", "band"]))
    stages.drop(at)
    return left


def side(left: DataFrame, known: DataFrame, x: str) -> DataFrame:
    """Rows of ``left`` with what ``known`` says of their members, in columns named for side ``x`` of a join."""
    names = {"member": x, "n": f"n{x}", "comp": f"c{x}", "sketch": f"k{x}", "wide": f"w{x}"}
    return left.join(known, "member").select("no", "band", *[F.col(c).alias(new) for c, new in names.items()])


def member_links(docs: DataFrame, members: DataFrame, cfg: MinMax, stages: Stages) -> DataFrame:
    """``(node, component)`` over ``members(member, n, bands, first)``, one row for each different set."""
    banded = members.select("member", F.posexplode("bands").alias("no", "band"))
    drawn = [F.min(F.struct(F.xxhash64(F.lit(i), "member").alias("r"), F.col("member").alias("c")))["c"] for i in range(1, cfg.centres)]
    # only bands with two members or more matter
    heads = banded.groupBy("no", "band").agg(F.count(F.lit(1)).alias("size"), F.array(F.min("member"), *drawn).alias("centres"))
    heads = stages.keep(heads.where("size > 1").select("no", "band", "centres"))
    shared = stages.keep(banded.join(heads, ["no", "band"]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash())
    wanted = members.join(shared.select("member").distinct(), "member", "left_semi").select("member", F.col("first.doc_id").alias("_d"), F.col("first.t").alias("_t"))
    chosen = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t"))).select("member", "text")
    # what is left are copies of one row
    sets = stages.keep(full_sets(chosen, cfg).dropDuplicates(["member"]))
    stars = shared.select("member", F.explode(F.array_distinct("centres")).alias("c")).where("c != member")
    stars = stars.select(F.least("c", "member").alias("a"), F.greatest("c", "member").alias("b")).distinct()
    links = stages.keep(confirmed(stars, sets, cfg))
    comp = components(links, stages)
    left = split_bands(shared, comp, stages)
    known = sets.join(left.select("member").distinct(), "member", "left_semi")
    known = stages.keep(sketches(known, cfg).join(members.select("member", "n"), "member"))
    # members drawn for the band first, then all that are still apart
    key = lambda i: F.struct(F.xxhash64(F.lit(i), "no", "band", "member").alias("r"), F.col("member").alias("m"))
    some = left.groupBy("no", "band").agg(F.array_distinct(F.array(*[F.min(key(i))["m"] for i in range(cfg.centres)])).alias("some"))
    some = left.join(some.select("no", "band", F.explode("some").alias("member")), ["no", "band", "member"])
    tries = side(left, known, "a").join(side(some, known, "b"), ["no", "band"]).where("a != b and ca != cb").where(may_link(cfg))
    tries = tries.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    drawn = stages.keep(confirmed(tries, sets, cfg))
    if not drawn.isEmpty():
        links = links.union(drawn)
        comp = components(links, stages)
        stages.drop(left)
        left = split_bands(shared, comp, stages)
    tries = side(left, known, "a").join(side(left, known, "b"), ["no", "band"]).where("a < b and ca != cb").where(may_link(cfg)).select("a", "b").distinct()
    more = stages.keep(confirmed(tries, sets, cfg))
    stages.drop(heads, shared, left, known)
    return comp if more.isEmpty() else components(links.union(more), stages)


def judged(docs: DataFrame, cfg: MinMax) -> DataFrame:
    """``(doc_id, t, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``, ``t`` being its text's hash."""
    stages = Stages(docs.sparkSession, "minmax")
    signed = stages.keep(signatures(docs, cfg))
    key = ["f1", "f2", "n"]
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    classes = signed.where("n > 0").groupBy(*key).agg(F.min(row).alias("first"), F.any_value("bands").alias("bands"))
    classes = stages.keep(classes.select(F.xxhash64(*key).alias("member"), *key, "first", "bands"))
    comp = member_links(docs, classes.select("member", "n", "bands", "first"), cfg, stages)
    # only linked members take their first row from others
    roots = comp.select(F.col("component").alias("node"), "component").distinct()
    linked = stages.keep(classes.select("member", "first").join(comp.union(roots).withColumnRenamed("node", "member"), "member"))
    named = linked.groupBy("component").agg(F.min("first").alias("head"))
    heads = linked.select("member", "component").join(named, "component").select("member", "head")
    groups = stages.keep(classes.join(heads, "member", "left").select(*key, F.coalesce("head", "first").alias("head")))
    out = signed.select("doc_id", "t", *key).join(groups, key, "left")
    kept = F.col("head").isNull() | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("t") == F.col("head.t")))
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, cfg: MinMax = MinMax()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``."""
    return judged(docs, cfg).drop("t")


def drop_near_duplicates(docs: DataFrame, cfg: MinMax = MinMax()) -> DataFrame:
    """``docs`` with one document of each group, all columns kept, whatever their names. Rows that repeat both doc_id and text
    count as one."""
    kept = judged(docs, cfg).where("kept").select(F.col("doc_id").alias("id"), "t").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("t"))
    one = rows.join(kept, same, "left_semi").select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")).dropDuplicates(["doc_id", "text"])
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
