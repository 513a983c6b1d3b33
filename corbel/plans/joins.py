"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corbel.operators.joins import (
    anti_join,
    membership_join,
    membership_pairs,
    outer_join,
    pair_join,
    semi_join,
    suffixed_join,
    top_detail,
    top_rows,
    using_join,
)
from corbel.plans.registry import query
from corbel.plans.tables import table

TOP = 10


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


def clicks(spark, sf_dir):
    """Events with the customer they belong to; most customers have none."""
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")


# Every second order has such an event, and every second event such an order.
MATCHED_SQL = "(SELECT event_id * 2 AS event_key, event_id, event_type FROM events)"


def matched_events(spark, sf_dir):
    key = (F.col("event_id") * 2).alias("event_key")
    return table(spark, sf_dir, "events").select(key, "event_id", "event_type")


@query(
    "join_inner",
    """SELECT c_custkey, c_name, o_custkey, o_orderkey FROM customer
       JOIN orders ON c_custkey = o_custkey""",
)
def join_inner(spark, sf_dir):
    left = customers(spark, sf_dir)
    right = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return left.join(right, left["c_custkey"] == right["o_custkey"], "inner")


@query(
    "join_left",
    """SELECT c_custkey, c_name, user_id, event_id, event_type FROM customer
       LEFT JOIN events ON c_custkey = user_id""",
)
def join_left(spark, sf_dir):
    return outer_join(
        customers(spark, sf_dir), clicks(spark, sf_dir), {"c_custkey": "user_id"}, "left"
    )


@query(
    "join_right",
    """SELECT user_id, event_id, event_type, c_custkey, c_name FROM events
       RIGHT JOIN customer ON user_id = c_custkey""",
)
def join_right(spark, sf_dir):
    return outer_join(
        clicks(spark, sf_dir), customers(spark, sf_dir), {"user_id": "c_custkey"}, "right"
    )


@query(
    "join_full",
    f"""SELECT o_orderkey, o_totalprice, event_key, event_id, event_type FROM orders
       FULL JOIN {MATCHED_SQL} ON o_orderkey = event_key""",
)
def join_full(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return outer_join(left, matched_events(spark, sf_dir), {"o_orderkey": "event_key"}, "full")


@query(
    "join_semi",
    """SELECT c_custkey, c_name FROM customer
       WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def join_semi(spark, sf_dir):
    return semi_join(customers(spark, sf_dir), clicks(spark, sf_dir), {"c_custkey": "user_id"})


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def join_anti(spark, sf_dir):
    return anti_join(customers(spark, sf_dir), clicks(spark, sf_dir), {"c_custkey": "user_id"})


@query(
    "join_using",
    """SELECT n_nationkey AS c_nationkey, c_custkey, n_name FROM customer
       JOIN nation ON c_nationkey = n_nationkey""",
)
def join_using(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    right = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return using_join(left, right, {"c_nationkey": "n_nationkey"})


@query(
    "join_drop_dup",
    """SELECT c_custkey, c_nationkey AS nationkey, n_name FROM customer
       JOIN nation ON c_nationkey = n_nationkey""",
)
def join_drop_dup(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nationkey")
    )
    right = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return left.join(right, left["nationkey"] == right["nationkey"]).drop(right["nationkey"])


@query(
    "join_rename_dup",
    """SELECT c_custkey, c_nationkey AS nationkey, n_nationkey AS nationkey_right, n_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def join_rename_dup(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nationkey")
    )
    right = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return suffixed_join(left, right, {"nationkey": "nationkey"})


# Tags of a part: its brand (twice, so that duplicates matter) and its type;
# the smallest parts have none.
TAGGED_SQL = """tagged AS (
  SELECT p_partkey, CASE WHEN p_size <= 2 THEN CAST([] AS VARCHAR[])
    ELSE [p_brand, p_type, p_brand] END AS tags FROM part),
 labels_known AS (
  SELECT p_brand AS tag, count(*) AS parts FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1
  UNION ALL
  SELECT 'not a ' || p_type AS tag, count(*) AS parts FROM part GROUP BY p_type)"""


def tagged_parts(spark, sf_dir):
    none = F.array().cast("array<string>")
    tags = F.when(F.col("p_size") <= 2, none).otherwise(F.array("p_brand", "p_type", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", tags.alias("tags"))


def known_tags(spark, sf_dir):
    """Tags to look up: one brand is missing, and no part has those of the types."""
    tag = F.explode(F.array("p_brand", F.concat(F.lit("not a "), "p_type")))
    tags = table(spark, sf_dir, "part").select(tag.alias("tag")).filter(F.col("tag") != "Brand#7")
    return tags.groupBy("tag").agg(F.count("*").alias("parts"))


@query(
    "join_array_contains",
    f"""WITH {TAGGED_SQL}
       SELECT p_partkey, tag, parts FROM tagged JOIN labels_known ON list_contains(tags, tag)""",
)
def join_array_contains(spark, sf_dir):
    joined = membership_join(tagged_parts(spark, sf_dir), known_tags(spark, sf_dir), "tags", "tag")
    return joined.select("p_partkey", "tag", "parts")


@query(
    "join_array_outer",
    f"""WITH {TAGGED_SQL}
       SELECT p_partkey, CAST(len(tags) AS INTEGER) AS tag_count, tag, parts
       FROM tagged FULL JOIN labels_known ON list_contains(tags, tag)""",
)
def join_array_outer(spark, sf_dir):
    pairs = membership_pairs(
        tagged_parts(spark, sf_dir),
        known_tags(spark, sf_dir),
        "tags",
        "tag",
        how="full",
        left_key=["p_partkey"],
    )
    # An absent side is null, and so is its size.
    count = F.when(F.col("_1").isNotNull(), F.size("_1.tags"))
    return pairs.select("_1.p_partkey", count.alias("tag_count"), "_2.tag", "_2.parts")


PAIRS_SQL = f"""SELECT o_orderkey IS NULL AS left_absent, event_id IS NULL AS right_absent,
         o_orderkey, o_orderstatus, event_id, event_type
       FROM orders {{how}} JOIN {MATCHED_SQL} ON o_orderkey = event_key"""


def order_pairs(spark, sf_dir, how):
    left = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    right = matched_events(spark, sf_dir)
    return pair_join(left, right, {"o_orderkey": "event_key"}, how).select(
        F.col("_1").isNull().alias("left_absent"),
        F.col("_2").isNull().alias("right_absent"),
        "_1.o_orderkey",
        "_1.o_orderstatus",
        "_2.event_id",
        "_2.event_type",
    )


@query("join_pairs", PAIRS_SQL.format(how="INNER"))
def join_pairs(spark, sf_dir):
    return order_pairs(spark, sf_dir, "inner")


@query("join_pairs_outer", PAIRS_SQL.format(how="FULL"))
def join_pairs_outer(spark, sf_dir):
    return order_pairs(spark, sf_dir, "full")


def dearest_order(spark, sf_dir):
    """Each customer with the price of the dearest order.

    The orders are reduced to one row per customer before they meet the
    customers, so the join moves no order rows and has no hot key. Right because
    a customer's key is unique: the result has one row for each.
    """
    dearest = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("dearest"))
    )
    left = customers(spark, sf_dir)
    joined = left.join(dearest, left["c_custkey"] == dearest["o_custkey"])
    return joined.select("c_custkey", "c_name", "dearest")


@query(
    "join_agg_max",
    """SELECT c_custkey, c_name, max(o_totalprice) AS dearest FROM customer
       JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2 ORDER BY 1 DESC""",
)
def join_agg_max(spark, sf_dir):
    return dearest_order(spark, sf_dir).orderBy(F.col("c_custkey").desc())


@query(
    "join_topk_back",
    f"""WITH top AS (
         SELECT c_custkey, c_name, max(o_totalprice) AS dearest FROM customer
         JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
         ORDER BY dearest DESC, c_custkey LIMIT {TOP})
       SELECT c_custkey, o_orderpriority, max(o_orderdate) AS latest, c_name, dearest
       FROM orders JOIN top ON o_custkey = c_custkey GROUP BY 1, 2, 4, 5""",
)
def join_topk_back(spark, sf_dir):
    best = [F.col("dearest").desc(), F.col("c_custkey")]
    top = top_rows(dearest_order(spark, sf_dir), best, TOP)
    detail = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderdate"
    )
    # Only the orders of the top customers are grouped.
    kept = top_detail(detail, top, TOP, ["c_custkey"])
    return kept.groupBy("c_custkey", "o_orderpriority", "c_name", "dearest").agg(
        F.max("o_orderdate").alias("latest")
    )
