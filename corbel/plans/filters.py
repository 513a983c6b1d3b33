"""Filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corbel.functions.predicates import (
    alternation,
    any_of,
    contains_any,
    extracts,
    matches_any,
    or_zero,
)
from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, table, with_evn

WANTED = ["small", "red"]


@query("flt_neq", with_evn("SELECT event_id, genre FROM evn WHERE genre <> 'view'"))
def flt_neq(spark, sf_dir):
    return nullable_events(spark, sf_dir).filter(F.col("genre") != "view").select("event_id", "genre")


@query("flt_string", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def flt_string(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "flt_chain",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_totalprice > 150000""",
)
def flt_chain(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .filter(F.col("o_totalprice") > 150000)
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "flt_flag",
    with_evn("SELECT event_id FROM evn WHERE genre = 'view' AND rating > 7.0"),
)
def flt_flag(spark, sf_dir):
    good = (F.col("genre") == "view") & (F.col("rating") > 7.0)
    flagged = nullable_events(spark, sf_dir).select("event_id", good.alias("good"))
    return flagged.where("good").select("event_id")


@query(
    "flt_not",
    with_evn("SELECT event_id FROM evn WHERE NOT (genre = 'view' AND rating > 7.0)"),
)
def flt_not(spark, sf_dir):
    good = (F.col("genre") == "view") & (F.col("rating") > 7.0)
    flagged = nullable_events(spark, sf_dir).select("event_id", good.alias("good"))
    return flagged.where(~F.col("good")).select("event_id")


@query(
    "flt_contains",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
       WHERE contains(p_name, 'small')""",
)
def flt_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").select("*").where(F.col("p_name").contains("small"))


@query(
    "flt_any_of",
    """SELECT p_partkey, p_name FROM part
       WHERE contains(p_name, 'small') OR contains(p_name, 'red')""",
)
def flt_any_of(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.filter(contains_any(F.col("p_name"), WANTED))


@query(
    "flt_any_of_mixed",
    """SELECT p_partkey FROM part
       WHERE p_size > 40 OR p_brand = 'Brand#7' OR starts_with(p_name, 'hot')""",
)
def flt_any_of_mixed(spark, sf_dir):
    wanted = [F.col("p_size") > 40, F.col("p_brand") == "Brand#7", F.col("p_name").startswith("hot")]
    return table(spark, sf_dir, "part").filter(any_of(wanted)).select("p_partkey")


@query(
    "flt_regex",
    "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'small|red')",
)
def flt_regex(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.filter(matches_any(F.col("p_name"), WANTED))


@query(
    "flt_regex_extract",
    """SELECT p_partkey, regexp_extract(p_name, 'small|red', 0) AS found FROM part
       WHERE regexp_extract(p_name, 'small|red', 0) <> ''""",
)
def flt_regex_extract(spark, sf_dir):
    pattern = alternation(WANTED)
    return (
        table(spark, sf_dir, "part")
        .filter(extracts(F.col("p_name"), pattern))
        .select("p_partkey", F.regexp_extract("p_name", pattern, 0).alias("found"))
    )


@query(
    "flt_unprojected",
    with_evn("SELECT event_id, rating FROM evn WHERE genre = 'click' AND rating > 6"),
)
def flt_unprojected(spark, sf_dir):
    # The genre is filtered on but not part of the result.
    return (
        nullable_events(spark, sf_dir)
        .select("event_id", "rating")
        .where(F.col("genre") == "click")
        .where(F.col("rating") > 6)
    )


@query(
    "flt_null_default",
    with_evn("SELECT count(*) AS high_scores FROM evn WHERE coalesce(score, 0) > 100"),
)
def flt_null_default(spark, sf_dir):
    events = nullable_events(spark, sf_dir).filter(or_zero(F.col("score")) > 100)
    return events.agg(F.count("*").alias("high_scores"))


@query(
    "flt_between",
    """SELECT o_orderkey FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-01-01'""",
)
def flt_between(spark, sf_dir):
    # Text bounds are coerced to the type of the column, which stays bare for pushdown.
    dates = F.col("o_orderdate").between("1996-01-01", "1997-01-01")
    return table(spark, sf_dir, "orders").filter(dates).select("o_orderkey")
