"""Sharding by a two-pass external shuffle (operator 3), DataFrame functions only.

Pass one scatters records by a seeded hash into buckets of about ``bucket_bytes``; inside a bucket a second hash
scatters them into cells of about ``cell_rows``. Pass two shuffles every cell by Fisher-Yates, with draws from a seeded
hash. A uniform scatter followed by uniform shuffles of the parts is a uniform shuffle of the whole, so concatenating
the parts gives each record its place in one random order; place modulo the number of shards is the shard, the
quotient its slot. That keeps law ``rows``: counts differ by one at most, slots are gapless. The order depends on the
seed and the records alone, not on the cluster, and a lost executor's work repeats exactly.

Equal records are told apart by a copy number, so that a record that fills a third of the table is scattered as well.
Null doc_id or text: hashed as empty, sized 8 bytes with CRC 0. An empty table gives no rows. Extra columns: carried by
``write_shards``, ignored by ``shard_plan``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import Stages


#: Copies of a record are numbered in runs of this length, so that no array grows with their count.
COPY_RUN = 100_000


@dataclass(frozen=True)
class Shuffle:
    shards: int = 24
    seed: int = 17
    bucket_bytes: int = 64 << 20
    cell_rows: int = 32


def hashed(*parts: Column) -> Column:
    """A seeded, layout-independent 64-bit draw: xxhash64 of the parts' text, joined by ':'."""
    return F.xxhash64(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def fisher_yates(items: Column, draw) -> Column:
    """``items`` shuffled: for i from the last place down to 1, swap place i with place ``draw(i)`` in [0, i]."""

    def swap(a: Column, i: Column) -> Column:
        j = draw(i).cast("int")
        return F.transform(a, lambda x, k: F.when(k == i, F.get(a, j)).when(k == j, F.get(a, i)).otherwise(x))

    last = F.size(items) - 1
    return F.when(last > 0, F.aggregate(F.sequence(last, F.lit(1), F.lit(-1)), items, swap)).otherwise(items)


def placed_copies(docs: DataFrame, cfg: Shuffle) -> DataFrame:
    """The plan's rows with the number of each copy, from 1."""
    stages = Stages(docs.sparkSession, "shards")
    text = F.col("text").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    # equal records become one row with a count, then one row for each copy
    key = ["doc_id", "size", "text_crc32"]
    counted = sized.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    runs = counted.select(*key, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPY_RUN))).alias("run"))
    copies = F.sequence(F.col("run") + 1, F.least(F.col("run") + COPY_RUN, F.col("n")))
    records = stages.keep(runs.select(*key, F.explode(copies).alias("copy")))
    rows, size = records.agg(F.count(F.lit(1)), F.sum("size")).first()
    buckets = max(1, -(-(size or 0) // cfg.bucket_bytes))
    cells = max(1, -(-(rows or 0) // (buckets * cfg.cell_rows)))
    seed = F.lit(cfg.seed)
    scattered = records.select(
        F.pmod(hashed(seed, F.lit("bucket"), *map(F.col, [*key, "copy"])), F.lit(buckets)).alias("bucket"),
        F.pmod(hashed(seed, F.lit("cell"), *map(F.col, [*key, "copy"])), F.lit(cells)).alias("cell"),
        F.struct(*key, "copy").alias("record"),
    )
    cell = stages.keep(scattered.groupBy("bucket", "cell").agg(F.sort_array(F.collect_list("record")).alias("records")))
    # places: buckets one after the other (as many rows as buckets), cells one after the other in their bucket
    counts = cell.select("bucket", "cell", F.size("records").alias("n"))
    per_bucket = counts.groupBy("bucket").agg(F.sum("n").alias("n"))
    first = per_bucket.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_at"))
    inside = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    at = stages.keep(
        counts.withColumn("cell_at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(first, "bucket").select("bucket", "cell", (F.col("bucket_at") + F.col("cell_at")).alias("at"))
    )
    draw = lambda i: F.pmod(hashed(seed, F.lit("draw"), F.col("bucket"), F.col("cell"), i), i + 1)
    placed = cell.join(at, ["bucket", "cell"]).select("at", F.posexplode(fisher_yates(F.col("records"), draw)).alias("i", "record"))
    place = F.col("at") + F.col("i")
    return placed.select(
        "record.doc_id", "record.size", "record.text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(place, F.lit(cfg.shards)).cast("int").alias("shard"),
        F.floor(place / F.lit(cfg.shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "record.copy",
    )


def shard_plan(docs: DataFrame, cfg: Shuffle = Shuffle()) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs(doc_id, text)``."""
    return placed_copies(docs, cfg).drop("copy")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with ``_in`` behind it as often as needed to differ from all ``taken`` (lower case)."""
    while name.lower() in taken:
        name += "_in"
    return name


def write_shards(docs: DataFrame, path: str, cfg: Shuffle = Shuffle()) -> None:
    """Writes every row of ``docs`` under ``path/shard=N``, ordered by slot (column ``_slot``) within each file. Rows with
    equal doc_id and text share their places in some order. An input column named ``shard`` or ``_slot`` is written as
    ``shard_in`` or ``_slot_in``."""
    stages = Stages(docs.sparkSession, "shard-rows")
    text = F.col("text").cast("string")
    key = ["id", "crc", "size"]
    # written with the task that read them, so that copies are numbered in parts, whatever their count
    held = stages.keep(docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("crc"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.spark_partition_id().alias("part"),
    ))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = held.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n")).select(F.col("id").alias("_i"), F.col("crc").alias("_c"), F.col("size").alias("_s"), F.col("part").alias("_p"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy(*key, "part").orderBy(F.lit(0)))
    same = F.col("id").eqNullSafe(F.col("_i")) & (F.col("crc") == F.col("_c")) & (F.col("size") == F.col("_s"))
    left = held.withColumn("inside", inside).join(parts, same & (F.col("part") == F.col("_p"))).select("row", *key, (F.col("before") + F.col("inside")).alias("copy"))
    right = placed_copies(docs, cfg).select(F.col("doc_id").alias("_i"), F.col("text_crc32").alias("_c"), F.col("size").alias("_s"), F.col("copy").alias("_n"), "shard", F.col("slot").alias("_slot"))
    names = ["shard", "_slot"]
    taken = [*names, *(c.lower() for c in docs.columns if c.lower() not in names)]
    own = [F.col(f"row.`{c}`").alias(free_name(c, taken) if c.lower() in names else c) for c in docs.columns]
    rows = left.join(right, same & (F.col("copy") == F.col("_n"))).select(*own, "shard", "_slot")
    rows.repartition(cfg.shards, "shard").sortWithinPartitions("shard", "_slot").write.partitionBy("shard").parquet(path)
