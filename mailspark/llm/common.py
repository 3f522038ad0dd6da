"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local session without that setting (tests) gets a
    temporary folder; on a cluster an unset folder is an error, as a driver's own folder is not seen by executors."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="llm-scratch-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


class Stages:
    """Tables written under the shared scratch folder, to cut lineage and to be read several times.

    ``keep(df)`` writes ``df`` as Parquet and returns its reader: the rows survive lost executors. ``drop()`` deletes
    what was kept before, for tables that nothing lazy refers to any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for f in frames:
            path = self.paths.pop(id(f), None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def free_memory() -> None:
    """Hands memory that is free inside this process back to the machine, as Spark keeps its Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, freeing memory when its task ends."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        free_memory()

    return task


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element-wise and a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Cache(dict):
    """``word -> value``: what was used lately. At ``limit`` entries a new generation starts; entries of the last one return
    when used again, older ones go, so there are at most twice ``limit``."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def chunks(texts: list, most: int = 400_000):
    """Ranges ``(lo, hi)`` of ``texts`` holding about ``most`` characters each (one text at least)."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) if t else 0
        if total >= most:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def byte_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose strings in ``column`` take about ``most`` bytes each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(sizes, dtype=np.int64), 0
    while lo < batch.num_rows:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def starts(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def components(edges: DataFrame, stages: Stages, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the component being its smallest node.

    Alternates two steps until the edge set no longer changes: every node hands its larger neighbours the smallest node
    it knows, then every node ties its smaller neighbours to the smallest of them. Nothing is collected but one digest
    a round. A hub's edges meet their minimum through a join of two exchanges, which Spark may split; minima are
    aggregated before the shuffle. Each round's edges are a written table, so lineage stays short."""
    e = stages.keep(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    digest = None
    for _ in range(most_rounds):
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == digest:
            break
        digest = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stages.keep(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stages.keep(large.where("a != b").distinct())
        small_low = stages.keep(large.groupBy("a").agg(F.min("b").alias("m")))
        rest = large.join(small_low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old = e
        e = stages.keep(rest.union(small_low.select("a", F.col("m").alias("b"))).distinct())
        stages.drop(old, low, large, small_low)
    else:
        raise RuntimeError("components did not settle")
    # every edge is now (node, smallest node of its component)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
