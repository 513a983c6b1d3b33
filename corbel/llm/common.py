"""What several operators need: reading tables, written stages, Arrow batches of documents."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corbel.sources.scratch import scratch_path

#: Rows of an Arrow batch that are worked on at a time.
ROWS = 1024
#: A document's words are runs of anything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did.

    On a cluster whose machines do not share that folder, ship it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment
    paths = held.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        held["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, fixes what a later
    job would otherwise compute again, and gives the planner exact sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns(df: DataFrame, fields: list[T.StructField]) -> tuple[DataFrame, T.StructType]:
    """The frame without columns named as ``fields``, and its schema followed by them."""
    names = {field.name.lower() for field in fields}
    kept = df.select(*[quoted(name) for name in df.columns if name.lower() not in names])
    return kept, T.StructType([*kept.schema.fields, *fields])


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def map_batches(
    df: DataFrame,
    fields: list[T.StructField],
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """All columns of ``df`` and those that ``compute`` makes of each Arrow batch, in slices.

    A column of ``df`` named like a new one is replaced.
    """
    kept, schema = with_columns(df, fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                made = [
                    array.cast(field.type)
                    for array, field in zip(compute(batch), list(arrow)[batch.num_columns :])
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=arrow.names)

    return kept.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and where each row begins; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return whole, offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 22
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text; a longer row is one of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy()
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])
        for first, last in runs(offsets, limit):
            yield batch.slice(first, last - first)


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, of 2**16 rows at most; a longer row is one of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + (1 << 16), rows)
        yield first, last
        first = last
