"""Databases, managed tables and table transfer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from corbel.functions.paths import quoted
from corbel.sources.readers import Loader


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it exists; ``location`` holds its tables."""
    literal = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = "" if location is None else f" LOCATION '{literal}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


@contextmanager
def database(spark: SparkSession, name: str) -> Iterator[None]:
    """Make the database current for a block and restore the one before."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Write a managed table of the current database."""
    df.write.mode(mode).saveAsTable(name)


def transfer_tables(
    spark: SparkSession,
    load: Loader,
    names: Iterable[str],
    write: bool = False,
    view_prefix: str = "src_",
) -> None:
    """Register each loaded table as a temporary view, and optionally store it.

    A view hides a table of the same name, so views get a prefix: reading
    ``name`` reads the stored copy and not the source again.
    """
    for name in names:
        table = load(name)
        table.createOrReplaceTempView(view_prefix + name)
        if write:
            save_table(table, name)
