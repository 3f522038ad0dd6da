"""Multi-party perspective rotation of conversations (operator 6), DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and all others
as named users; the loss mask covers what the assistant says and its end mark. Messages of ``non_speakers`` (system
prompts) are rendered as such in every perspective and are no participants. The result has one row per conversation,
perspective and message: its segment, the segment's place in the rendered dialogue and its mask. Segments in order of
``start`` are the dialogue, so a conversation of any length is never gathered into one row. Places are running sums over
ranges of the sorted messages: a conversation that fills many ranges is summed in parallel.

Null role: the named user ``unknown``, no participant. Null text: empty. Null conv_id: one conversation. Messages are
ordered by turn (null first), role, text; equal rows are rendered each. A conversation without a participant gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import Stages


@dataclass(frozen=True)
class ChatFormat:
    non_speakers: tuple[str, ...] = ("system",)
    assistant: str = "<|assistant|>\n"
    user: str = "<|user name=%s|>\n"
    system: str = "<|system|>\n"
    end: str = "<|end|>\n"


def running_before(df: DataFrame, group: list[str], order: list[str], value: str, out: str, stages: Stages) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over earlier rows of the group. Rows are dealt out by ranges of
    (group, order); sums within a range need that range alone, and only totals per (group, range) meet across ranges."""
    ranged = stages.keep(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    before = (Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, "_part").agg(F.sum(value).alias("_total"))
    at = stages.keep(totals.select(*group, "_part", F.coalesce(F.sum("_total").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(*before)), F.lit(0)).alias("_at")))
    inner = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(*before)
    summed = ranged.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    right = at.select(*(F.col(g).alias(f"_g_{g}") for g in group), F.col("_part").alias("_p"), "_at")
    on = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_part") == F.col("_p")]
    joined = summed.join(right, on)
    return joined.withColumn(out, F.col("_in") + F.col("_at")).drop("_part", "_p", "_in", "_at", *(f"_g_{g}" for g in group))


def rotate(conversations: DataFrame, fmt: ChatFormat = ChatFormat()) -> DataFrame:
    """``(conv_id, perspective, turn, role, segment, start, end, mask_start, mask_end)`` from
    ``conversations(conv_id, turn, role, text)``; places are code points, ends exclusive; masks are null where the
    perspective's speaker doesn't speak."""
    stages = Stages(conversations.sparkSession, "chat")
    said = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    speaker = F.col("role").isNotNull() & ~F.col("role").isin(*fmt.non_speakers)
    who = stages.keep(said.where(speaker).select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct())
    seen = said.join(who, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    before, _, after = fmt.user.partition("%s")
    own = F.col("role").eqNullSafe(F.col("perspective"))
    system = F.coalesce(F.col("role").isin(*fmt.non_speakers), F.lit(False))
    named = F.concat(F.lit(before), F.coalesce("role", F.lit("unknown")), F.lit(after))
    head = F.when(own, F.lit(fmt.assistant)).when(system, F.lit(fmt.system)).otherwise(named)
    parts = seen.select("conv_id", "perspective", "turn", "role", head.alias("_head"), F.concat("text", F.lit(fmt.end)).alias("_body"), own.alias("_own"))
    parts = parts.select("conv_id", "perspective", "turn", "role", "_own", F.length("_head").cast("long").alias("_skip"), F.concat("_head", "_body").alias("segment"))
    parts = stages.keep(parts.withColumn("_n", F.length("segment").cast("long")))
    placed = running_before(parts, ["conv_id", "perspective"], ["turn", "role", "segment"], "_n", "start", stages)
    end = F.col("start") + F.col("_n")
    return placed.select(
        "conv_id", "perspective", "turn", "role", "segment", "start", end.alias("end"),
        F.when(F.col("_own"), F.col("start") + F.col("_skip")).alias("mask_start"),
        F.when(F.col("_own"), end).alias("mask_end"),
    )
