"""Queries written as SQL text over temporary views."""

from __future__ import annotations

from corbel.plans.registry import query
from corbel.plans.tables import table

FIRST, LAST = "1996-01-01", "1997-01-01"


def views(spark, sf_dir, *names):
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(f"v_{name}")


@query("sql_view_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def sql_view_filter(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return spark.sql(
        "SELECT o_orderkey FROM v_orders WHERE o_orderstatus = :status", args={"status": "F"}
    )


@query(
    "sql_between_count",
    f"""SELECT count(*) AS placed FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}'""",
)
def sql_between_count(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return spark.sql(
        f"SELECT count(*) AS placed FROM v_orders WHERE o_orderdate BETWEEN '{FIRST}' AND '{LAST}'"
    )


@query(
    "sql_join_group_avg",
    f"""SELECT round(avg(o_totalprice), 4) AS avg_price, n_name
       FROM customer JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
       WHERE o_orderdate BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}' GROUP BY n_name""",
)
def sql_join_group_avg(spark, sf_dir):
    views(spark, sf_dir, "orders", "customer", "nation")
    return spark.sql(f"""
      SELECT ROUND(AVG(o_totalprice), 4) AS avg_price, n_name
      FROM v_orders
      INNER JOIN v_customer ON o_custkey = c_custkey
      INNER JOIN v_nation ON c_nationkey = n_nationkey
      WHERE o_orderdate BETWEEN '{FIRST}' AND '{LAST}'
      GROUP BY n_name""")


@query(
    "sql_join_top1",
    f"""SELECT round(avg(o_totalprice), 4) AS avg_price, n_name, r_name
       FROM customer JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey
       WHERE o_orderdate BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}'
       GROUP BY n_name, r_name ORDER BY avg_price DESC, n_name LIMIT 1""",
)
def sql_join_top1(spark, sf_dir):
    views(spark, sf_dir, "orders", "customer", "nation", "region")
    return spark.sql(f"""
      SELECT ROUND(AVG(o_totalprice), 4) AS avg_price, n_name, r_name
      FROM v_orders
      INNER JOIN v_customer ON o_custkey = c_custkey
      INNER JOIN v_nation ON c_nationkey = n_nationkey
      INNER JOIN v_region ON n_regionkey = r_regionkey
      WHERE o_orderdate BETWEEN '{FIRST}' AND '{LAST}'
      GROUP BY n_name, r_name
      ORDER BY avg_price DESC, n_name
      LIMIT 1""")
