"""File, database and partition-controlled sinks.

Save modes are Spark's: ``overwrite``, ``append``, ``ignore``, ``error``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corbel.operators.layout import rebalanced
from corbel.session import setting

#: Bytes of JSON in a file that holds one array.
ARRAY_BYTES = 16 << 20
#: Files that a round of writing them has at least.
ROUND_FILES = 64


def write_json(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """JSON lines."""
    df.write.mode(mode).options(**options).json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", **options) -> None:
    """Delimited text with a header line; ``sep="\\t"`` writes TSV."""
    df.write.mode(mode).options(**{"sep": sep, "header": True, **options}).csv(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """One text column, one line per row."""
    df.write.mode(mode).options(**options).text(path)


def write_json_arrays(
    df: DataFrame,
    path: str,
    pretty: bool = False,
    array_bytes: int = ARRAY_BYTES,
    item: Column | None = None,
    item_bytes: Column | None = None,
    rounds: int = 1,
    **options,
) -> None:
    """JSON arrays, one for each file: what ``multiLine`` reads.

    Such a file is read whole, so its size is bounded: the rows are dealt out to as many files
    as hold about ``array_bytes`` of JSON each, or one row. They are dealt out before their JSON
    is made, which is then written row by row: no JSON is shuffled and no task holds an array.

    ``item`` is the struct written for a row, all columns if not given: a large one is best made
    here from the columns of a small ``df``. ``item_bytes`` is about the length of a row's JSON;
    without it the JSON is made once more to be measured. ``options`` are those of text files.

    Up to so many ``rounds`` read ``df`` one after the other, each the rows with its share of
    hashes. Only a round's rows lie in a shuffle then, beside the files written so far.
    """
    spark = df.sparkSession
    item = F.struct(*df.columns) if item is None else item
    json = F.to_json(item, {"pretty": str(pretty).lower()})
    share = F.pmod(F.xxhash64(*df.columns), F.lit(rounds)) if rounds > 1 else F.lit(0)
    size = F.octet_length(json) if item_bytes is None else item_bytes
    measured = df.groupBy(share.alias("share")).agg(F.sum(size).alias("bytes")).collect()
    sizes = {row["share"]: row["bytes"] or 0 for row in measured}
    rounds = max(1, min(rounds, int(sum(sizes.values()) / array_bytes / ROUND_FILES)))
    # Dealt by place: equal rows must not meet in one file. A partition is a file.
    place, file = "__place", "__file"
    beside = Window.partitionBy(file).orderBy(place)
    ends = {"__first": F.lag(place).over(beside).isNull(), "__last": F.lead(place).over(beside).isNull()}
    before = F.when(F.col("__first"), "[\n").otherwise("")
    after = F.when(F.col("__last"), "\n]").otherwise(",")
    for turn in range(rounds):
        total = sum(size for part, size in sizes.items() if part % rounds == turn)
        files = max(1, math.ceil(total / array_bytes))
        dealt = (
            (df.filter(share % rounds == turn) if rounds > 1 else df)
            .withColumn(place, F.monotonically_increasing_id())
            .withColumn(file, F.pmod(F.xxhash64(place), F.lit(files)).cast("int"))
            .repartitionById(files, file)
        )
        lines = dealt.withColumns(ends).select(F.concat(before, json, after).alias("value"))
        with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            write_text(lines, path, "append" if turn else "overwrite", **options)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy"
) -> None:
    """Parquet with as many files as the frame has partitions."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_default(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The session's default format."""
    df.write.mode(mode).save(path)


def write_partitions(
    df: DataFrame, path: str, partitions: int | None = None, shuffle: bool = True,
    mode: str = "overwrite",
) -> None:
    """Parquet with a controlled number of files.

    A number with ``shuffle`` gives exactly that many even files, without it at
    most that many by merging neighbours. No number leaves the file count to the
    data, at the session's advisory partition size.
    """
    if partitions is None:
        df = rebalanced(df)
    else:
        df = df.repartition(partitions) if shuffle else df.coalesce(partitions)
    write_parquet(df, path, mode)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Parquet in a folder for each value of the columns ``by``, whole or in addition."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Only the folders that ``df`` has rows for are overwritten, whatever the session says."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def written_files(spark: SparkSession, path: str, *aggregates: Column) -> DataFrame:
    """``file`` and ``rows`` of the Parquet files below a folder, and aggregates of each.

    Files are told apart by the hidden ``_metadata`` column; without aggregates no column is read.
    """
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
    return files.agg(F.count("*").alias("rows"), *aggregates)


def write_jdbc(
    df: DataFrame, options: Mapping[str, str], mode: str = "error",
    connections: int | None = None, batch_rows: int = 10_000,
) -> None:
    """Database table; at most ``connections`` tasks write at the same time."""
    writer = df.write.format("jdbc").mode(mode).options(**options).option("batchsize", batch_rows)
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.save()
