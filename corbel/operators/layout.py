"""Sorting, stacking and partitioning of frames."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corbel.sources.scratch import scratch_path


def sort_total(df: DataFrame, order: Sequence[Column | str], tiebreak: Sequence[str]) -> DataFrame:
    """Global sort whose order is total.

    The tiebreak columns take part in the range boundaries, so a value held by
    many rows is spread over several sort tasks, and the result is repeatable.
    """
    return df.orderBy(*order, *tiebreak)


def ranked(
    df: DataFrame, order: Sequence[Column | str], tiebreak: Sequence[str], name: str = "place"
) -> DataFrame:
    """All rows with their place, from 1, in a total order.

    A window without partitions would number all rows in one task. Here the rows are sorted
    over range partitions and written with their place in their partition; a place
    is that plus the rows of the partitions before. Only the partitions' row counts reach
    the driver. The sorted rows are written because a second sort may cut the ranges elsewhere.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    # The number holds the partition in its upper bits, the place there in the lower 33.
    numbered = sort_total(df, order, tiebreak).withColumn("__at", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftright("__at", 33)
    counts = sorted(stored.groupBy(part.alias("part")).count().collect())
    before = accumulate((row["count"] for row in counts), initial=0)
    offsets = spark.createDataFrame(
        [(row["part"], offset) for row, offset in zip(counts, before)], "__part bigint, __before bigint"
    )
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # One row for each sort partition.
    joined = stored.join(F.broadcast(offsets), part == F.col("__part"))
    return joined.withColumn(name, place).drop("__at", "__part", "__before")


def stack(first: DataFrame, second: DataFrame, by_name: bool = True) -> DataFrame:
    """All rows of both frames, matched by column name or by position."""
    return first.unionByName(second) if by_name else first.union(second)


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even partitions of the advisory size, measured while the shuffle runs.

    Needs no row or byte estimate, splits hot values of ``columns`` and merges
    small ones: the layout to write files from.
    """
    return df.hint("rebalance", *columns)
