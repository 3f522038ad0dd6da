"""Near-duplicate vectors by collision counting on sorted projections (operator 8).

Unit vectors are projected on many random directions. Sorting all vectors along all directions and counting windows for
all pairs would cost the square of the table whatever the windows, so each vector enters only the sorted lists of the
``lists`` directions (with sign) on which it lies farthest out, where near vectors meet often and others hardly ever.
Along each list, a vector's window reaches ``window`` beyond its own value; windows are joined by cells of that width,
each with the next. Collisions are counted per pair, and pairs that reach the calibrated count are verified by cosine in
double precision. The count is the largest one that at least ``recall`` of simulated pairs at exactly the least cosine
reach, with the same directions. The number of directions grows with the square root of the table, so that chance
collisions per vector grow as that root, and not as the table.

Equal vectors are folded into one class first and counted, so thousands of copies are one member.

Vectors that are null, zero, or hold null or non-finite components, and rows with null vec_id, link with nothing; so do
vectors of different lengths. Rows that repeat a vec_id count as vectors of their own. Empty table: no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Stages, components


@dataclass(frozen=True)
class Projections:
    cosine: float = 0.9
    lists: int = 20
    per_root: float = 128.0  # directions: per_root * sqrt(vectors), rounded up to a power of two
    least: int = 512
    window: float = 1.2
    recall: float = 0.985
    seed: int = 11
    block_floats: int = 1 << 21  # numbers of directions drawn and held at once


def direction_blocks(dim: int, m: int, cfg: Projections) -> Iterator[tuple[int, np.ndarray]]:
    """The ``m`` directions in blocks ``(number of the first, rows)``; the last one drawn is remembered."""
    rows = max(64, cfg.block_floats // dim)
    for lo in range(0, m, rows):
        key = (cfg.seed, dim, m, lo)
        if _DRAWN.get("key") != key:
            _DRAWN["block"] = np.random.default_rng(key).standard_normal((min(rows, m - lo), dim)).astype(np.float32)
            _DRAWN["key"] = key
        yield lo, _DRAWN["block"]


_DRAWN: dict = {}


def farthest(unit: np.ndarray, m: int, cfg: Projections) -> tuple[np.ndarray, np.ndarray]:
    """For each row the numbers of the lists (2 per direction) where it lies farthest out, and how far."""
    unit = unit.astype(np.float32)
    lists, far = np.empty((len(unit), 0), np.int64), np.empty((len(unit), 0), np.float32)
    for lo, a in direction_blocks(unit.shape[1], m, cfg):
        found, size = [], []
        for at in range(0, len(unit), 200):
            p = unit[at : at + 200] @ a.T
            k = min(cfg.lists, p.shape[1])
            j = np.argpartition(-np.abs(p), k - 1, axis=1)[:, :k]
            value = np.take_along_axis(p, j, axis=1)
            found.append(2 * (j + lo) + (value < 0))
            size.append(np.abs(value))
        lists, far = np.hstack([lists, np.concatenate(found)]), np.hstack([far, np.concatenate(size)])
        if lists.shape[1] > cfg.lists:
            j = np.argpartition(-far, cfg.lists - 1, axis=1)[:, : cfg.lists]
            lists, far = np.take_along_axis(lists, j, axis=1), np.take_along_axis(far, j, axis=1)
    return lists, far


def calibrated_count(dim: int, m: int, cfg: Projections, pairs: int = 2000) -> int:
    """The largest count that ``recall`` of random pairs at the least cosine reach (1 at least)."""
    if dim < 2:
        return 1
    rng = np.random.default_rng([cfg.seed, dim, m, 1])
    x = rng.standard_normal((pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((pairs, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = cfg.cosine * x + np.sqrt(1 - cfg.cosine**2) * z
    (lx, vx), (ly, vy) = farthest(x, m, cfg), farthest(y, m, cfg)
    counts = np.zeros(pairs, np.int64)
    for lo in range(0, pairs, 250):
        at = slice(lo, lo + 250)
        met = (lx[at, :, None] == ly[at, None, :]) & (np.abs(vx[at, :, None] - vy[at, None, :]) <= cfg.window)
        counts[at] = met.sum(axis=(1, 2))
    reached = np.sort(counts)[int((1 - cfg.recall) * pairs)]
    return max(1, int(reached))


def listed(classes: DataFrame, m: int, cfg: Projections) -> DataFrame:
    """``(cid, list, value)``: each class in its ``lists`` farthest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid = b.column(0).to_numpy()
            vectors = b.column(1)
            dims = np.diff(vectors.offsets.to_numpy())
            flat, off = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows), 5000):
                    some = rows[lo : lo + 5000]
                    v = np.stack([flat[off[i] : off[i] + dim] for i in some])
                    v /= np.linalg.norm(v, axis=1, keepdims=True)
                    lists, value = farthest(v, m, cfg)
                    k = lists.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(cid[some], k)), pa.array(np.full(len(some) * k, dim, np.int32)), pa.array(lists.ravel()), pa.array(value.ravel().astype(np.float64))],
                        ["cid", "dim", "list", "value"],
                    )

    return classes.select("cid", "u").mapInArrow(run, "cid long, dim int, list long, value double")


def calibrated(dims: DataFrame, m: int, cfg: Projections) -> DataFrame:
    """``(dim, count)``: the count that pairs must reach, for each of ``dims(dim)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [calibrated_count(d, m, cfg) for d in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["dim", "count"])

    return dims.select("dim").mapInArrow(run, "dim int, count long")


def colliding(lists: DataFrame, counts: DataFrame, cfg: Projections) -> DataFrame:
    """``(a, b)``: pairs that meet in as many windows as ``counts(dim, count)`` asks, or more. A window joins its own cell and the next, by plain shuffle
    joins that Spark may split."""
    cell = F.floor(F.col("value") / cfg.window)
    x = lists.select("dim", "list", cell.alias("cell"), F.col("cid").alias("x"), F.col("value").alias("vx"))
    y = lists.select("dim", "list", F.explode(F.array(cell, cell - 1)).alias("cell"), F.col("cid").alias("y"), F.col("value").alias("vy"))
    met = x.join(y, ["dim", "list", "cell"]).where((F.col("vy") - F.col("vx")).between(0.0, cfg.window) & ((F.col("vy") > F.col("vx")) | (F.col("y") > F.col("x"))))
    pairs = met.where("x != y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.any_value("dim").alias("dim"))
    return pairs.join(counts, "dim").where(F.col("n") >= F.col("count")).select("a", "b")


def cosine(x, y):
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)
    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def vector_links(vectors: DataFrame, cfg: Projections = Projections()) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding)``."""
    stages = Stages(vectors.sparkSession, "collisions")
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = stages.keep(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(finite & F.col("vec_id").isNotNull(), v).alias("v")))
    # by the largest component, so that no square overflows and not all vanish; cosines stay
    largest = F.array(F.array_max(F.transform("v", F.abs)))
    scaled = F.transform(largest, lambda most: F.transform("v", lambda x: x / most))[0]  # the largest is found once
    classes = stages.keep(
        rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .select("v", scaled.alias("u"), "rep", "copies", F.monotonically_increasing_id().alias("cid"))
    )
    n = classes.count()
    m = max(cfg.least, 1 << int(np.ceil(np.log2(max(1.0, cfg.per_root * np.sqrt(n))))))
    counts = stages.keep(calibrated(classes.select(F.size("v").alias("dim")).distinct(), m, cfg))
    lists = stages.keep(listed(classes, m, cfg))
    pairs = stages.keep(colliding(lists, counts, cfg))
    one = lambda side: classes.select(F.col("cid").alias(side), F.col("u").alias(f"v{side}"))
    links = stages.keep(pairs.join(one("a"), "a").join(one("b"), "b").where(cosine(F.col("va"), F.col("vb")) >= cfg.cosine).select("a", "b"))
    comp = components(links, stages)
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("cid").alias("b"), "copies")
    degree = both.join(copies, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("copies").alias("others"))
    named = stages.keep(
        classes.select("cid", "v", "rep", "copies").join(comp.withColumnRenamed("node", "cid"), "cid", "left").join(degree, "cid", "left")
        .select("v", "rep", F.coalesce("component", "cid").alias("comp"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    smallest = stages.keep(named.groupBy("comp").agg(F.min("rep").alias("component_id")))
    named = stages.keep(named.join(smallest, "comp").select("v", "n_links", "component_id"))
    out = rows.join(named, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
