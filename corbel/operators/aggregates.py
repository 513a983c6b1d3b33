"""Aggregate expressions and group operators.

All of them aggregate partially before the shuffle, so a hot key costs one row
per task and not one task for all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corbel.functions.paths import column_at
from corbel.functions.predicates import or_zero


def integer_mean(column: Column) -> Column:
    """Integer mean that counts nulls as zero and truncates; null without rows."""
    total = F.sum(or_zero(column))
    return F.call_function("div", total, F.nullif(F.count(F.lit(1)), F.lit(0)))


def corr_with_zeros(left: Column, right: Column) -> Column:
    """Pearson correlation that reads null as zero, as ``df.stat.corr`` does."""
    return F.corr(or_zero(left), or_zero(right))


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = 12
) -> DataFrame:
    """Per group, a sketch of each column's distinct values, to be stored and merged later.

    A sketch has at most 2**``lg_k`` registers, however many values it has seen; its standard
    error is about 0.8 / 2**(``lg_k`` / 2). Nulls are not counted.
    """
    return df.groupBy(*[column_at([name]) for name in by]).agg(
        *[F.hll_sketch_agg(column_at([name]), F.lit(lg_k)).alias(name) for name in columns]
    )


def merged_distinct(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Estimates of distinct counts per coarser group, from stored sketches alone."""
    return sketches.groupBy(*[column_at([name]) for name in by]).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(column_at([name]))).alias(name) for name in columns]
    )


def least_row(columns: Sequence[str], order: Sequence[str]) -> Column:
    """The row that comes first by ``order``, as a struct.

    End ``order`` with a unique column to settle ties.
    """
    return F.min_by(
        F.struct(*[column_at([name]) for name in columns]),
        F.struct(*[column_at([name]) for name in order]),
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per key, the values of the row that comes last by ``order``."""
    best = F.max_by(
        F.struct(*[column_at([name]) for name in values]),
        F.struct(*[column_at([name]) for name in order]),
    )
    return (
        df.groupBy(*[column_at([key]) for key in keys])
        .agg(best.alias("__best"))
        .select(*[column_at([key]) for key in keys], "__best.*")
    )


def collect_groups(
    df: DataFrame,
    keys: Sequence[str],
    members: Sequence[str],
    spread: Column,
    width: int = 100_000,
    fold: bool = False,
) -> DataFrame:
    """Materialise the rows of each group as arrays of bounded size.

    Returns the keys, ``chunk`` and ``members``, a sorted array of structs of the
    member columns. ``chunk`` is ``spread div width``, whatever the size of the
    group: an array holds the rows of at most ``width`` values of ``spread``, an
    integer expression that should be unique to a row or nearly so. There is one
    shuffle, by keys and chunk. With ``fold`` equal members are counted
    (``copies``) before it and not repeated.
    """
    group = [column_at([key]) for key in keys]
    inner = [column_at([name]) for name in members]
    chunked = df.withColumn("chunk", F.call_function("div", spread.cast("long"), F.lit(width)))
    if fold:
        chunked = chunked.groupBy(*group, "chunk", *inner).agg(F.count(F.lit(1)).alias("copies"))
        inner = [*inner, F.col("copies")]
    return chunked.groupBy(*group, "chunk").agg(
        F.sort_array(F.collect_list(F.struct(*inner))).alias("members")
    )
