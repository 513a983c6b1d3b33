"""Session settings the library is written for.

The caller owns the session: nothing here names a master, a memory size or a
number of executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps mean the same on every executor.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, turns a join
    # into a broadcast once the *measured* side is small, splits hot partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Middle of the 10-100 MB a partition should hold.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
}


def configure(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """Apply :data:`SETTINGS` and then ``extra`` to a session builder."""
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
