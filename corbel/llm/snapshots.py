"""Logged conversations collapsed to the longest of each, and rendered for chat training.

Logs hold a conversation again and again, each time with a few more turns. A
rolling hash of each conversation's first k turns identifies every prefix; an
anti-join drops the conversations whose whole is a proper prefix of another.
Running values are taken in two levels (within chunks of turns, then over
chunks), so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corbel.llm.common import settle

#: Turns of a chunk, by their number, and of a rendered segment.
CHUNK = 256
SEGMENT = 512

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def rolled(turns: DataFrame) -> DataFrame:
    """Turns with ``place`` (from 1), ``n_turns`` and ``p1``, ``p2``: hashes of all turns so far.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. Turns follow by number (null
    first), then role and text. The prefix hash is an exclusive-or of hashes of
    place, role and text, 128 bits in all; null and empty values differ.
    """
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-1 << 60)).cast("bigint")
    spread = turns.select("conv_id", "turn", "role", "text").withColumn("chunk", chunk)
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    placed = spread.withColumn("within", F.row_number().over(within))
    keys = placed.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    chunks = Window.partitionBy("conv_id").orderBy("chunk")
    bases = keys.select(
        F.col("conv_id").alias("c"),
        F.col("chunk").alias("k"),
        F.coalesce(F.sum("n").over(chunks.rowsBetween(*_BEFORE)), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))
    numbered = placed.join(bases, same).drop("c", "k").withColumn(
        "place", F.col("base") + F.col("within")
    )

    def turn_hash(seed: int):
        parts = [F.col("place"), F.lit(seed)]
        for name in ("role", "text"):
            parts += [F.col(name).isNull(), F.col(name)]
        return F.xxhash64(*parts)

    hashed = settle(
        numbered.select(
            "conv_id", "turn", "role", "text", "chunk", "place", "n_turns",
            turn_hash(1).alias("h1"), turn_hash(2).alias("h2"),
        ),
        "turns",
    )
    sums = hashed.groupBy("conv_id", "chunk").agg(
        F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")
    )

    def running(column: str, order, frame):
        return F.coalesce(F.bit_xor(column).over(order.rowsBetween(*frame)), F.lit(0))

    starts = sums.select(
        F.col("conv_id").alias("c"),
        F.col("chunk").alias("k"),
        running("x1", chunks, _BEFORE).alias("b1"),
        running("x2", chunks, _BEFORE).alias("b2"),
    )
    inner = Window.partitionBy("conv_id", "chunk").orderBy("place")
    return hashed.join(starts, same).select(
        "conv_id", "turn", "role", "text", "place", "n_turns",
        F.col("b1").bitwiseXOR(running("h1", inner, _UP_TO_HERE)).alias("p1"),
        F.col("b2").bitwiseXOR(running("h2", inner, _UP_TO_HERE)).alias("p2"),
    )


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv_id`` of conversations that are no proper prefix of another.

    Of equal conversations the one with the smallest id stays (null before all).
    """
    ends = (
        prefixes.where("place = n_turns")
        .groupBy("place", "p1", "p2")
        .agg(F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("least"))
    )
    # Common first turns are one row each before they meet.
    longer = prefixes.where("place < n_turns").select("place", "p1", "p2").distinct()
    return ends.join(longer, ["place", "p1", "p2"], "left_anti").select(
        F.col("least.conv_id").alias("conv_id")
    )


def collapse(turns: DataFrame) -> DataFrame:
    """Rendered maximal conversations: ``conv_id``, ``segment``, ``n_turns``, ``rendered``.

    Every turn is ``<|im_start|>role``, a line end, its text, ``<|im_end|>`` and a line
    end; a null role is ``unknown``, a null text empty. A conversation is one row for each
    512 turns (``segment`` from 0), ``n_turns`` counts the whole conversation. Turns with a
    null ``conv_id`` are one conversation. An empty table gives no row.
    """
    prefixes = settle(rolled(turns), "prefixes")
    kept = maximal(prefixes).withColumnRenamed("conv_id", "kept_id")
    rendered = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
        F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"),
    )
    stay = prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    segment = F.expr(f"(place - 1) div {SEGMENT}").cast("bigint")
    return (
        stay.select("conv_id", segment.alias("segment"), "n_turns", "place", rendered.alias("line"))
        .groupBy("conv_id", "segment", "n_turns")
        .agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
        .select(
            "conv_id", "segment", "n_turns",
            F.concat_ws("", F.transform("lines", lambda x: x["line"])).alias("rendered"),
        )
    )
