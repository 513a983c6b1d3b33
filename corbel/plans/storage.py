"""Source, sink and catalog queries: tables are written by Spark and read back.

What is written goes to a new folder below the session's shared one. Databases
are not queried over JDBC here, because none is at hand that executors share;
the option builders and the transfer are tested apart.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.operators.joins import anti_join
from corbel.operators.layout import rebalanced
from corbel.plans.nested import LINES_SQL, stored_documents
from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, table, with_evn
from corbel.sources.catalog import create_database, database, save_table, transfer_tables
from corbel.sources.readers import (
    conform,
    from_rows,
    number_range,
    read_csv,
    read_format,
    read_json,
    read_text,
    split_damaged,
    strict,
)
from corbel.sources.records import bind_record
from corbel.sources.scratch import scratch_path
from corbel.sources.writers import (
    replace_partitions,
    write_csv,
    write_default,
    write_json,
    write_json_arrays,
    write_parquet,
    write_partitioned,
    write_partitions,
    write_text,
    written_files,
)

EVENT_SCHEMA = "event_id BIGINT, genre STRING, rating DOUBLE, score BIGINT"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
DAY_SQL = "CAST(o_orderdate AS DATE)"


@query("src_json", with_evn("SELECT event_id, genre, rating, score FROM evn"))
def src_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    write_json(nullable_events(spark, sf_dir), path)
    return read_json(spark, path)


@query("src_json_schema", with_evn("SELECT event_id, genre, rating, score FROM evn"))
def src_json_schema(spark, sf_dir):
    path = scratch_path(spark, "json-schema")
    write_json(nullable_events(spark, sf_dir), path)
    return read_format(spark, "json", EVENT_SCHEMA, **strict({"path": path}))


# Every 17th line is cut short, every 19th has a text where a number belongs.
DAMAGED_SQL = """CASE WHEN event_id % 17 = 0 THEN concat('{"event_id":', event_id, ',"gen')
    WHEN event_id % 19 = 0 THEN concat('{"event_id":"no. ', event_id, '"}') END"""


def damaged_lines(spark, sf_dir):
    """Good events and damaged lines, read once from one JSON file set."""
    path = scratch_path(spark, "json-damaged")
    whole = F.to_json(F.struct("event_id", "genre", "rating", "score"))
    line = F.coalesce(F.expr(DAMAGED_SQL), whole)
    write_text(nullable_events(spark, sf_dir).select(line.alias("value")), path)
    return split_damaged(spark, "json", path, T.StructType.fromDDL(EVENT_SCHEMA))


@query(
    "src_json_quarantine",
    with_evn(f"""SELECT event_id, genre, rating, score, NULL AS line FROM evn
       WHERE event_id % 17 <> 0 AND event_id % 19 <> 0
       UNION ALL SELECT NULL, NULL, NULL, NULL, {DAMAGED_SQL} FROM evn
       WHERE event_id % 17 = 0 OR event_id % 19 = 0"""),
)
def src_json_quarantine(spark, sf_dir):
    good, damaged = damaged_lines(spark, sf_dir)
    return good.unionByName(damaged, allowMissingColumns=True)


@query(
    "src_json_quarantine_counts",
    """SELECT count(*) FILTER (event_id % 17 <> 0 AND event_id % 19 <> 0) AS good,
         count(*) FILTER (event_id % 17 = 0 OR event_id % 19 = 0) AS damaged FROM events""",
)
def src_json_quarantine_counts(spark, sf_dir):
    good, damaged = damaged_lines(spark, sf_dir)
    kinds = good.select(F.lit(1).alias("good")).unionByName(
        damaged.select(F.lit(1).alias("damaged")), allowMissingColumns=True
    )
    return kinds.agg(F.count("good").alias("good"), F.count("damaged").alias("damaged"))


@query("src_json_flags", f"SELECT o_orderkey, {DAY_SQL} AS day FROM orders")
def src_json_flags(spark, sf_dir):
    path = scratch_path(spark, "json-flags")
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    line = F.format_string("{'o_orderkey': %d, 'day': '%s'}", "o_orderkey", day)
    write_text(table(spark, sf_dir, "orders").select(line.alias("value")), path)
    flags = {"allowSingleQuotes": True, "dateFormat": "dd/MM/yyyy", "compression": "uncompressed"}
    return read_json(spark, path, "o_orderkey BIGINT, day DATE", **flags)


@query("src_json_multiline", CUSTOMER_SQL)
def src_json_multiline(spark, sf_dir):
    path = scratch_path(spark, "json-multiline")
    customer = table(spark, sf_dir, "customer")
    write_json_arrays(customer, path, pretty=True)
    return read_json(spark, path, customer.schema, multiLine=True)


STOCKS_SQL = f"SELECT o_orderpriority AS symbol, {DAY_SQL} AS date, o_totalprice AS price FROM orders"


def stocks(spark, sf_dir):
    """Orders as symbol, written date and price."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.date_format("o_orderdate", "MMM d yyyy").alias("date"),
        F.col("o_totalprice").alias("price"),
    )


@query("src_csv", STOCKS_SQL)
def src_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(stocks(spark, sf_dir), path)
    schema = "symbol STRING, date DATE, price DOUBLE"
    return read_csv(spark, path, schema, dateFormat="MMM d yyyy", nullValue="")


@query(
    "src_csv_inferred",
    """SELECT p_partkey AS part, p_name AS name, p_retailprice AS price, p_size AS size FROM part""",
)
def src_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv-inferred")
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS part", "p_name AS name", "p_retailprice AS price", "p_size AS size"
    )
    write_csv(part, path)
    # Inference finds the narrowest type that fits; the record type is declared.
    declared = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("size", T.IntegerType()),
        ]
    )
    return conform(read_csv(spark, path), declared)


@query(
    "src_text",
    """SELECT value, count(*) AS copies FROM (
         SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
)
def src_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    write_text(table(spark, sf_dir, "documents").select("text"), path, lineSep="\n")
    lines = read_text(spark, path, lineSep="\n")
    return lines.groupBy("value").agg(F.count("*").alias("copies"))


STATUS_NAMES = [("F", "finished"), ("O", "open")]


@query(
    "src_local",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status
       FROM orders""",
)
def src_local(spark, sf_dir):
    # Two rows written above: safe to broadcast.
    names = F.broadcast(from_rows(spark, STATUS_NAMES, ["o_orderstatus", "status"]))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(names, "o_orderstatus", "left").select("o_orderkey", "status")


@query(
    "src_range",
    """SELECT k AS o_orderkey FROM (
         SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS k FROM orders)
       WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def src_range(spark, sf_dir):
    # Order numbers of the whole range that have no line item.
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    numbers = number_range(spark, ends[0], ends[1], "o_orderkey")
    return anti_join(numbers, table(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"})


@query(
    "typed_schema",
    "SELECT c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey FROM customer",
)
def typed_schema(spark, sf_dir):
    record = T.StructType(
        [
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_custkey", T.LongType()),
        ]
    )
    return conform(table(spark, sf_dir, "customer"), record)


NESTED_RECORD = """enriched struct<document: struct<
  lang: string, doc_id: bigint NOT NULL,
  paragraphs: array<struct<
    size: bigint, number: bigint NOT NULL, words: array<struct<place: struct<rank: bigint NOT NULL>, size: double>>>
  > NOT NULL>> NOT NULL"""


@query(
    "typed_schema_nested",
    f"""WITH {LINES_SQL},
 sized AS (SELECT doc_id, lang, number, length(line) AS size,
   list_filter(range(1, len(w) + 1), lambda i: w[i] <> '') AS places FROM lines)
       SELECT doc_id, lang, count(*) AS paragraphs, CAST(sum(size) AS BIGINT) AS sizes,
         CAST(sum(coalesce(list_sum(places), 0)) AS BIGINT) AS ranks FROM sized GROUP BY doc_id, lang""",
)
def typed_schema_nested(spark, sf_dir):
    # As read from files every field may be null; the record says which may not.
    record = T.StructType.fromDDL(NESTED_RECORD)
    bound = bind_record(stored_documents(spark, sf_dir), record).select("enriched.document.*")
    sizes = F.aggregate("paragraphs", F.lit(0).cast("bigint"), lambda total, x: total + x["size"])
    ranks = F.flatten(
        F.transform("paragraphs", lambda x: F.transform(F.array_compact(x["words"]), lambda y: y["place"]["rank"]))
    )
    return bound.select(
        "doc_id",
        "lang",
        F.size("paragraphs").cast("bigint").alias("paragraphs"),
        sizes.alias("sizes"),
        F.aggregate(ranks, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("ranks"),
    )


@query("sink_parquet", CUSTOMER_SQL)
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "customer"), path, compression="snappy")
    return spark.read.parquet(path)


@query("sink_default", CUSTOMER_SQL)
def sink_default(spark, sf_dir):
    path = scratch_path(spark, "default")
    write_default(table(spark, sf_dir, "customer"), path)
    return spark.read.load(path)


@query("sink_tsv", CUSTOMER_SQL)
def sink_tsv(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    customer = table(spark, sf_dir, "customer")
    write_csv(customer, path, sep="\t")
    return read_csv(spark, path, customer.schema, sep="\t")


@query(
    "sink_partitioned",
    """SELECT o_orderkey, o_totalprice, layout, files, count(*) OVER (PARTITION BY layout) AS rows,
         CAST(sum(o_orderkey) OVER (PARTITION BY layout) AS BIGINT) AS keys
       FROM orders, (VALUES ('shuffled', 30::BIGINT), ('merged', 15::BIGINT), ('measured', 1::BIGINT))
         AS layouts(layout, files)""",
)
def sink_partitioned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    many = int(spark.conf.get("corbel.files.shuffled", "30"))
    fewer = int(spark.conf.get("corbel.files.merged", "15"))
    # Numbers of files that the caller sets, and files of the advisory size.
    layouts = {
        "shuffled": (orders, {"partitions": many}),
        "merged": (orders.repartition(many), {"partitions": fewer, "shuffle": False}),
        "measured": (orders, {}),
    }
    parts, counted = [], []
    for name, (frame, settings) in layouts.items():
        path = scratch_path(spark, name)
        write_partitions(frame, path, **settings)
        files = written_files(spark, path, F.sum("o_orderkey").alias("keys"))
        totals = files.agg(
            F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("keys").alias("keys")
        )
        parts.append(spark.read.schema(orders.schema).parquet(path).withColumn("layout", F.lit(name)))
        counted.append(totals.withColumn("layout", F.lit(name)))
    stored, totals = reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, counted)
    # A layout's row of totals beside every row that was written.
    return stored.join(F.broadcast(totals), "layout").select(
        *orders.columns, "layout", "files", "rows", "keys"
    )


@query(
    "sink_save_modes",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'
       UNION ALL SELECT -o_orderkey, o_totalprice, o_orderstatus FROM orders
         WHERE o_orderstatus = 'F' AND o_totalprice > 200000
       UNION ALL SELECT o_orderkey, 0.0, o_orderstatus FROM orders
         WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0""",
)
def sink_save_modes(spark, sf_dir):
    path = scratch_path(spark, "modes") + "/orders"
    by = ["o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", *by)
    write_partitioned(orders, path, by, mode="error")
    dear = orders.filter("o_orderstatus = 'F' AND o_totalprice > 200000")
    write_partitioned(dear.withColumn("o_orderkey", -F.col("o_orderkey")), path, by, mode="append")
    # The folder exists: nothing is written.
    write_partitioned(orders, path, by, mode="ignore")
    # One folder is replaced, the others stay.
    even = orders.filter("o_orderstatus = 'O' AND o_orderkey % 2 = 0")
    replace_partitions(even.withColumn("o_totalprice", F.lit(0.0)), path, by)
    return spark.read.schema(orders.schema).parquet(path)


@contextmanager
def _own_database(spark):
    """A new database for a block, dropped afterwards with its tables."""
    name = f"db_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, scratch_path(spark, name))
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def _kept(df, label):
    """A copy of a frame that outlives the database it is read from."""
    path = scratch_path(df.sparkSession, label)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


@query("cat_table", CUSTOMER_SQL)
def cat_table(spark, sf_dir):
    with _own_database(spark) as name:
        with database(spark, name):
            save_table(table(spark, sf_dir, "customer"), "customer_copy")
        return _kept(spark.read.table(f"{name}.customer_copy"), "cat-table")


@query(
    "cat_transfer",
    """SELECT n_name, r_name, s_name FROM supplier
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def cat_transfer(spark, sf_dir):
    with _own_database(spark) as name:
        names = ["nation", "region", "supplier"]
        with database(spark, name):
            transfer_tables(
                spark,
                lambda wanted: table(spark, sf_dir, wanted),
                names,
                write=True,
                view_prefix=f"{name}_",
            )
        # One table is read from its view, the others from the stored copies.
        joined = spark.sql(
            f"""SELECT n_name, r_name, s_name FROM {name}_supplier
                INNER JOIN {name}.nation ON s_nationkey = n_nationkey
                INNER JOIN {name}.region ON n_regionkey = r_regionkey"""
        )
        kept = _kept(joined, "cat-transfer")
        for wanted in names:
            spark.catalog.dropTempView(f"{name}_{wanted}")
        return kept
