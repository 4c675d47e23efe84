"""Multi-party perspective rotation, DataFrame operations only.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and everyone else as a named user:

    <|assistant|>\\ntext\\n<|end|>\\n           the perspective's own turns
    <|user name=NAME|>\\ntext\\n<|end|>\\n      other speakers

``rotate`` gives one row per (conversation, perspective, turn): the segment,
its place in the rendered dialogue (character offsets), its mask (1 where the
perspective speaks) and the target span (the text and the end mark, without
the header). ``render`` joins segments into texts of at most ``turns`` turns,
so an ordinary dialogue is one row and a conversation holding a third of
all turns is many bounded rows, never one value or one task.

Turns are range-partitioned by (conversation, turn, ...), which cuts a hot
conversation over many partitions; positions and offsets are running sums
inside a partition plus sums of the partitions before it.

Defined cases: a null role is the speaker ``unknown`` (as is an empty one); null text is
empty; a null conv_id is one conversation of its own, and null turns come
first. Turns repeating a number are ordered by role, then text; equal rows stay
repeated. A conversation with one speaker has one perspective. Empty tables give no rows;
only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import shared_table

CHUNK_TURNS = 64
ASSISTANT, END = "<|assistant|>\n", "\n<|end|>\n"


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """Turns with the range partition (``part``) and place in it (``nth``), written once."""
    role = F.trim(F.coalesce("role", F.lit("")))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(role == "", "unknown").otherwise(role).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = ["conv_id", "turn", "speaker", "h"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    return shared_table(rows.select("conv_id", "speaker", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("nth")), "turns")


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, position, speaker, segment, seg_start, seg_end, mask, target_start, target_end."""
    turns = _ordered_turns(conversations)
    views = turns.select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    seen = turns.join(views, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    speaks = F.col("speaker") == F.col("perspective")
    header = F.when(speaks, F.lit(ASSISTANT)).otherwise(F.concat(F.lit("<|user name="), "speaker", F.lit("|>\n")))
    seen = seen.withColumn("segment", F.concat(header, "text", F.lit(END))).withColumn("len", F.length("segment").cast("bigint"))
    zero = F.lit(0).cast("bigint")
    here = ["part", "conv_id", "perspective"]  # the rows of one partition: bounded, however large the conversation
    inside = Window.partitionBy(*here).orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.select("*", F.count(F.lit(1)).over(inside).alias("n_in"), F.coalesce(F.sum("len").over(inside), zero).alias("l_in"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = seen.groupBy(*here).agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("l"))
    sums = sums.select(
        F.col("part").alias("b_part"), F.col("conv_id").alias("b_conv"), F.col("perspective").alias("b_persp"),
        F.coalesce(F.sum("n").over(earlier), zero).alias("n0"), F.coalesce(F.sum("l").over(earlier), zero).alias("l0"))
    same = (F.col("part") == F.col("b_part")) & F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("perspective") == F.col("b_persp"))
    start = F.col("l0") + F.col("l_in")
    out = placed.join(sums, same)
    return out.select(
        "conv_id", "perspective", (F.col("n0") + F.col("n_in")).alias("position"), "speaker", "segment", start.alias("seg_start"),
        (start + F.col("len")).alias("seg_end"), speaks.cast("int").alias("mask"),
        F.when(speaks, start + len(ASSISTANT)).alias("target_start"), F.when(speaks, start + F.col("len") - 1).alias("target_end"))


def render(rotated: DataFrame, turns: int = CHUNK_TURNS) -> DataFrame:
    """conv_id, perspective, chunk, n_turns, text, text_start, n_targets, target_spans ("start-end,..." in the whole dialogue)."""
    rows = rotated.withColumn("chunk", F.floor(F.col("position") / turns).cast("bigint"))
    span = F.when(F.col("mask") == 1, F.concat_ws("-", "target_start", "target_end"))
    parts = F.array_sort(F.collect_list(F.struct("position", "segment", span.alias("span"))))  # at most ``turns`` of them
    rows = rows.groupBy("conv_id", "perspective", "chunk").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min("seg_start").alias("text_start"), F.sum("mask").alias("n_targets"), parts.alias("p"))
    return rows.select(
        "conv_id", "perspective", "chunk", "n_turns", F.array_join("p.segment", "").alias("text"), "text_start", "n_targets",
        F.array_join("p.span", ",").alias("target_spans"))
