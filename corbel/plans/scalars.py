"""Text, date, array and struct queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corbel.functions.arrays import element, tokens
from corbel.functions.dates import age_in_years, parse_dates
from corbel.functions.predicates import extracts
from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, table, texts, with_evn


@query(
    "str_initcap",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""",
)
def str_initcap(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.initcap("p_name").alias("title"))


@query(
    "str_upper",
    "SELECT c_custkey, upper(c_name) AS loud, lower(c_mktsegment) AS quiet FROM customer",
)
def str_upper(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.upper("c_name").alias("loud"), F.lower("c_mktsegment").alias("quiet")
    )


@query(
    "str_regex_replace",
    """SELECT p_partkey, regexp_replace(p_name, 'small|red', 'tiny', 'g') AS renamed FROM part
       WHERE regexp_extract(p_name, 'small|red', 0) <> ''""",
)
def str_regex_replace(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .filter(extracts(F.col("p_name"), "small|red"))
        .select("p_partkey", F.regexp_replace("p_name", "small|red", "tiny").alias("renamed"))
    )


@query(
    "arr_split",
    """SELECT doc_id, array_to_string(string_split_regex(text, ' |,'), '/') AS joined
       FROM documents""",
)
def arr_split(spark, sf_dir):
    words = tokens(F.col("text"))
    return texts(spark, sf_dir, "doc_id", "text").select("doc_id", F.array_join(words, "/").alias("joined"))


@query(
    "arr_size",
    """SELECT conv_id, turn, CAST(len(string_split_regex(text, ' |,')) AS INTEGER) AS words
       FROM conversations""",
)
def arr_size(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.size(tokens(F.col("text"))).alias("words")
    )


@query(
    "arr_contains",
    """SELECT doc_id, list_contains(string_split_regex(text, ' |,'), 'the') AS has_the
       FROM documents""",
)
def arr_contains(spark, sf_dir):
    found = F.array_contains(tokens(F.col("text")), "the")
    return texts(spark, sf_dir, "doc_id", "text").select("doc_id", found.alias("has_the"))


@query(
    "arr_element",
    """SELECT p_partkey, string_split_regex(p_name, ' |,')[1] AS first_word,
         string_split_regex(p_name, ' |,')[9] AS ninth_word FROM part""",
)
def arr_element(spark, sf_dir):
    words = tokens(F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        element(words, 0).alias("first_word"),
        element(words, 8).alias("ninth_word"),
    )


@query(
    "arr_filter",
    with_evn("""SELECT event_id,
         CAST(len(list_filter([score, event_id, NULL], lambda x: x IS NOT NULL)) AS INTEGER) AS present
       FROM evn"""),
)
def arr_filter(spark, sf_dir):
    values = F.array("score", "event_id", F.lit(None).cast("bigint"))
    present = F.filter(values, lambda item: item.isNotNull())
    return nullable_events(spark, sf_dir).select("event_id", F.size(present).alias("present"))


@query(
    "struct_build",
    """SELECT o_orderkey, o_totalprice AS money_price, o_orderpriority AS money_rank,
         o_custkey AS pair_customer FROM orders""",
)
def struct_build(spark, sf_dir):
    built = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct("o_totalprice", "o_orderpriority").alias("money"),
        F.expr("(o_orderkey, o_custkey)").alias("pair"),
    )
    return built.select(
        "o_orderkey",
        F.col("money.o_totalprice").alias("money_price"),
        F.col("money.o_orderpriority").alias("money_rank"),
        F.col("pair.o_custkey").alias("pair_customer"),
    )


@query("struct_get", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def struct_get(spark, sf_dir):
    built = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.struct("o_totalprice", "o_orderpriority").alias("money")
    )
    return built.select("o_orderkey", F.col("money").getField("o_totalprice").alias("price"))


@query("date_parse", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def date_parse(spark, sf_dir):
    # Two-digit years: the pivot decides the century.
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd-MMM-yy").alias("written")
    )
    return text.select(
        "o_orderkey", parse_dates(F.col("written"), "dd-MMM-yy", pivot=2040).alias("parsed")
    )


@query(
    "date_parse_multi",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed
       FROM orders""",
)
def date_parse_multi(spark, sf_dir):
    day = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "MMM d yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-MM-dd"))
        .otherwise("not a date")
    )
    formats = ["MMM d yyyy", "yyyy-MM-dd"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_dates(written, formats).alias("parsed")
    )


@query(
    "date_age",
    """SELECT o_orderkey,
         CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) / 365 AS age
       FROM orders""",
)
def date_age(spark, sf_dir):
    age = age_in_years(F.col("o_orderdate").cast("date"), dt.date(2002, 1, 1))
    return table(spark, sf_dir, "orders").select("o_orderkey", age.alias("age"))


@query(
    "date_now",
    """SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), current_date) / 365 > 20 AS is_old,
         o_orderdate < CAST(now() AS TIMESTAMP) AS is_past FROM orders""",
)
def date_now(spark, sf_dir):
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (age_in_years(day.cast("date")) > 20).alias("is_old"),
        (day < F.current_timestamp().cast("timestamp_ntz")).alias("is_past"),
    )
