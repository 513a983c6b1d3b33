"""The test tables, and the frames derived from them that several queries use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, with the schema that its files have now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for queries that take whole texts apart."""
    return table(spark, sf_dir, "documents").select(*columns)


# The test tables hold no nulls; this view of the events has them in three
# columns. The same expressions in SQL, for the oracles.
NULLABLE_EVENTS_SQL = """evn AS (
  SELECT event_id,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS genre,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS rating,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS score
  FROM events)"""


def with_evn(sql: str) -> str:
    """Oracle over the nullable events."""
    return f"WITH {NULLABLE_EVENTS_SQL}\n{sql}"


def nullable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nulls: every 13th genre, 7th rating and 11th score."""

    def unless(divisor: int, column: str) -> Column:
        return F.when(F.col("event_id") % divisor != 0, F.col(column))

    return table(spark, sf_dir, "events").select(
        "event_id",
        unless(13, "event_type").alias("genre"),
        unless(7, "value").alias("rating"),
        unless(11, "user_id").alias("score"),
    )
