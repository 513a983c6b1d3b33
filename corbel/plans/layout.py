"""Sorting, limit and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corbel.operators.joins import top_rows
from corbel.operators.layout import ranked, stack
from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, table, with_evn

# Rows are compared without regard to their order, so each says its place.
ALL_SQL = with_evn(
    "SELECT event_id, genre, rating, score, row_number() OVER (ORDER BY {}) AS place FROM evn"
)


def sorted_events(spark, sf_dir, order):
    return ranked(nullable_events(spark, sf_dir), order, ["event_id"]).orderBy("place")


@query("sort_asc", ALL_SQL.format("rating ASC NULLS FIRST, event_id"))
def sort_asc(spark, sf_dir):
    return sorted_events(spark, sf_dir, ["rating"])


@query("sort_desc", ALL_SQL.format("rating DESC NULLS LAST, event_id"))
def sort_desc(spark, sf_dir):
    return sorted_events(spark, sf_dir, [F.col("rating").desc()])


@query("sort_nulls_last", ALL_SQL.format("genre ASC NULLS LAST, rating DESC NULLS LAST, event_id"))
def sort_nulls_last(spark, sf_dir):
    order = [F.col("genre").asc_nulls_last(), F.col("rating").desc_nulls_last()]
    return sorted_events(spark, sf_dir, order)


@query(
    "topk_nulls",
    with_evn("SELECT event_id, score FROM evn ORDER BY score ASC NULLS FIRST, event_id DESC LIMIT 10"),
)
def topk_nulls(spark, sf_dir):
    events = nullable_events(spark, sf_dir).select("event_id", "score")
    return top_rows(events, [F.col("score"), F.col("event_id").desc()], 10)


@query(
    "topk",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("take_n", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10")
def take_n(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type").orderBy("event_id").limit(10)


@query(
    "set_union",
    """SELECT c_name AS name, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_name, s_nationkey FROM supplier""",
)
def set_union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return stack(customer, supplier)


@query(
    "set_union_positional",
    """SELECT c_name AS name, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_name, s_nationkey FROM supplier""",
)
def set_union_positional(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    supplier = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return stack(customer, supplier, by_name=False)


@query("set_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def set_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
