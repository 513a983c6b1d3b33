"""Projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, table, with_evn


@query("proj_columns", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def proj_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    by_reference = part.select(
        part["p_partkey"], F.col("p_name"), F.column("p_brand"), F.expr("p_type"), part.p_size
    )
    return by_reference.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@query(
    "proj_expr",
    """SELECT o_orderkey, o_totalprice / CAST(2.2 AS DOUBLE) AS scaled,
         o_orderkey + o_custkey AS key_sum FROM orders""",
)
def proj_expr(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice / 2.2D AS scaled", "o_orderkey + o_custkey AS key_sum"
    )


@query(
    "proj_arith",
    """SELECT c_custkey, c_custkey / CAST(2.2 AS DOUBLE) AS kilos,
         (c_acctbal / 10 + c_nationkey) / 2 AS blend FROM customer""",
)
def proj_arith(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey"),
        (F.col("c_custkey") / 2.2).alias("kilos"),
        ((F.col("c_acctbal") / 10 + F.col("c_nationkey")) / 2).alias("blend"),
    )


@query(
    "proj_null_arith",
    with_evn("SELECT event_id, score + event_id AS total, rating * 10 AS tenfold FROM evn"),
)
def proj_null_arith(spark, sf_dir):
    return nullable_events(spark, sf_dir).select(
        "event_id",
        (F.col("score") + F.col("event_id")).alias("total"),
        (F.col("rating") * 10).alias("tenfold"),
    )


@query(
    "proj_with_column",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_extendedprice * (1 - l_discount) AS revenue FROM lineitem""",
)
def proj_with_column(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "revenue")
    )


@query("proj_rename", 'SELECT p_partkey, p_size AS "size in units" FROM part')
def proj_rename(spark, sf_dir):
    renamed = table(spark, sf_dir, "part").withColumnRenamed("p_size", "size in units")
    return renamed.selectExpr("p_partkey", "`size in units`")


@query("proj_drop", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def proj_drop(spark, sf_dir):
    return table(spark, sf_dir, "part").drop("p_brand", "p_type", "not_a_column")


@query("proj_literal", "SELECT p_partkey, 47 AS plain FROM part")
def proj_literal(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lit(47).alias("plain"))


@query(
    "proj_bool_flag",
    with_evn("SELECT event_id, genre = 'view' AND rating > 7.0 AS good FROM evn"),
)
def proj_bool_flag(spark, sf_dir):
    preferred = (F.col("genre") == "view") & (F.col("rating") > 7.0)
    return nullable_events(spark, sf_dir).select("event_id", preferred.alias("good"))


@query(
    "proj_rename_all",
    "SELECT r_regionkey AS id, r_name AS label FROM region",
)
def proj_rename_all(spark, sf_dir):
    return table(spark, sf_dir, "region").toDF("id", "label")


@query(
    "proj_aliased_frame",
    """SELECT child.n_name AS nation, parent.r_name AS region
       FROM nation AS child JOIN region AS parent ON child.n_regionkey = parent.r_regionkey""",
)
def proj_aliased_frame(spark, sf_dir):
    child = table(spark, sf_dir, "nation").alias("child")
    parent = table(spark, sf_dir, "region").alias("parent")
    return child.join(parent, F.col("child.n_regionkey") == F.col("parent.r_regionkey")).select(
        F.col("child.n_name").alias("nation"), F.col("parent.r_name").alias("region")
    )
