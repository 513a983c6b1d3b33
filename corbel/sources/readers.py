"""File and database scans.

A schema given by the caller saves the extra pass that inference makes over
JSON and CSV, and makes the result independent of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.paths import column_at
from corbel.sources.scratch import scratch_path

Schema = T.StructType | str
Loader = Callable[[str], DataFrame]


def _reader(spark: SparkSession, schema: Schema | None, options: Mapping[str, object]) -> DataFrameReader:
    reader = spark.read.options(**options)
    return reader if schema is None else reader.schema(schema)


def read_json(spark: SparkSession, path: str, schema: Schema | None = None, **options) -> DataFrame:
    """JSON lines; ``multiLine=True`` reads one value or array per whole file.

    Whole-file JSON cannot be split: one task reads one file.
    ``samplingRatio`` limits the inference pass to a share of the rows.
    """
    return _reader(spark, schema, options).json(path)


def read_csv(spark: SparkSession, path: str, schema: Schema | None = None, **options) -> DataFrame:
    """Delimited text with a header line; types are inferred without a schema."""
    settings = {"header": True, "sep": ",", **options}
    if schema is None:
        settings.setdefault("inferSchema", True)
    return _reader(spark, schema, settings).csv(path)


def read_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of text in a column ``value``."""
    return spark.read.options(**options).text(path)


def read_format(spark: SparkSession, kind: str, schema: Schema | None = None, **options) -> DataFrame:
    """Any format from an options map alone; the path is the option ``path``."""
    return _reader(spark, schema, options).format(kind).load()


def strict(options: Mapping[str, object] | None = None) -> dict[str, object]:
    """Options under which a malformed row aborts the read."""
    return {**(options or {}), "mode": "FAILFAST"}


def quarantine(schema: T.StructType, column: str = "_corrupt_record") -> tuple[T.StructType, dict]:
    """Schema and options that keep malformed rows as text in ``column``."""
    fields = [*schema.fields, T.StructField(column, T.StringType())]
    return T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": column}


def split_damaged(
    spark: SparkSession, kind: str, path: str, schema: T.StructType, **options
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the others as text (``line``), from one read.

    A parser looks only at the fields that a query asks for, so what counts as damaged would
    change from query to query, and a count would parse nothing. The files are therefore
    parsed once, with every field, and stored by outcome; both frames read that.
    """
    column = "__line"
    whole, modes = quarantine(schema, column)
    parsed = read_format(spark, kind, whole, **{**options, **modes, "path": path})
    stored = scratch_path(spark, "parsed")
    damaged = column_at([column]).isNotNull()
    parsed.withColumn("__damaged", damaged).write.mode("overwrite").partitionBy("__damaged").parquet(stored)
    fields = T.StructType([*whole.fields, T.StructField("__damaged", T.BooleanType())])
    kept = spark.read.schema(fields).parquet(stored)
    good = kept.filter(~F.col("__damaged")).select(*[column_at([name]) for name in schema.names])
    return good, kept.filter("__damaged").select(F.col(column).alias("line"))


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a database scan.

    Without a partition column the whole table is read by one task. With one,
    ``partitions`` tasks each read a range; the bounds only set the width of the
    ranges, rows outside them are read too.
    """
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    given = (partition_column, bounds, partitions)
    if any(value is not None for value in given):
        if any(value is None for value in given):
            raise ValueError("partition_column, bounds and partitions go together")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Database table as a frame; filters and column choices run in the database."""
    return spark.read.format("jdbc").options(**options).load()


def jdbc_tables(spark: SparkSession, options: Mapping[str, str], schema: str) -> Loader:
    """Loader of the tables of one database schema, for a table transfer.

    ``options`` are those of :func:`jdbc_options`; their table is replaced.
    """

    def load(name: str) -> DataFrame:
        return read_jdbc(spark, {**options, "dbtable": f"{schema}.{name}"})

    return load


def from_rows(
    spark: SparkSession, rows: Iterable[Sequence], names: Sequence[str] | Schema | None = None
) -> DataFrame:
    """Small local collection as a frame, with inferred or given column names."""
    return spark.createDataFrame(list(rows), names)


def number_range(spark: SparkSession, first: int, last: int, name: str = "value") -> DataFrame:
    """All integers from first to last, generated by the executors."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind a frame to a declared record type.

    Columns are matched by name, ordered and widened as declared, extra ones
    dropped; a missing or incompatible column, or a nullable one declared
    otherwise, is an error.
    """
    return df.to(schema)
