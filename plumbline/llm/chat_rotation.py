"""Multi-party perspective rotation: every dialogue from every participant's side.

For each participant of a conversation the dialogue is rendered once, with that
participant as the assistant, all others as users with their names, and the
characters to be learned: the participant's own turns with their closing marker.
System turns stay system turns and are nobody's side.

A conversation of any length is rendered in chunks of `chunk` turns.  Turns are
numbered without gathering a conversation: rows are sorted by range over all
partitions, and a turn's number is its place in its partition plus the turns of
its conversation in earlier ones.

Defined results: turns come in the order of turn (null last), role and text;
repeated rows are repeated turns.  A null role is the participant "unknown", a
null text is empty, rows without conversation are one conversation without id.
Markers inside a text are broken by a blank, so that no text can end its turn.
Conversations of system turns alone, and empty tables, give no rows.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import row_key, stored

#: Markers of the chat format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def numbered(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """`rows` with `nth`, their number from 0 within `key`, without gathering a key."""
    spread = rows.withColumn("_r", row_key()).repartitionByRange(F.col(key), *order, F.col("_r"))
    sorted_rows = spread.sortWithinPartitions(F.col(key), *order, F.col("_r")).drop("_r")
    placed = stored(sorted_rows.withColumn("_at", row_key()).withColumn("_part", F.spark_partition_id()))
    runs = placed.groupBy("_part", key).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumnRenamed(key, "_key")
    return (
        placed.withColumnRenamed("_part", "_p")
        .join(runs, (F.col("_p") == F.col("_part")) & F.col(key).eqNullSafe(F.col("_key")))
        .withColumn("nth", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_p", "_part", "_at", "_first", "_n", "_before", "_key")
    )


def rotated(conversations: DataFrame, chunk: int = 64) -> DataFrame:
    """Per conversation, participant and chunk: conv_id, perspective, chunk, n_turns, rendered, spans.

    spans: [start, end) of the characters of `rendered` to be learned.
    """
    broken = lambda c: F.replace(c, F.lit("<|im_"), F.lit("<| im_"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        broken(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("role"),
        broken(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    )
    order = [F.col("turn").isNull(), F.col("turn"), F.col("role"), F.col("text")]
    turns = numbered(rows, "conv_id", order).select(
        "conv_id",
        F.floor(F.col("nth") / chunk).alias("chunk"),
        F.struct("nth", "role", "text").alias("t"),
    )
    chunks = turns.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct()
    sides = chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def segment(t: Column) -> Column:
        head = (
            F.when(t["role"] == F.col("perspective"), F.lit("assistant"))
            .when(t["role"] == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), t["role"]))
        )
        return F.struct(
            F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"),
            F.concat(t["text"], F.lit(CLOSE), F.lit("\n")).alias("body"),
            (t["role"] == F.col("perspective")).alias("own"),
        )

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + F.length(s["head"])
        end = start + F.length(s["body"]) - 1  # the line break after the marker isn't learned
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"), F.when(s["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return (
        sides.withColumn("segments", F.transform("turns", segment))
        .select(
            "conv_id",
            "perspective",
            "chunk",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("rendered"),
            F.aggregate("segments", zero, step, lambda s: s["spans"]).alias("spans"),
        )
    )
