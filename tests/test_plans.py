"""Equivalent forms, and what the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from corbel.operators.layout import ranked, sort_total, stack
from corbel.plans.catalogue import QUERIES
from corbel.plans.tables import nullable_events, table
from tests.conftest import plan_of, rows

SF_DIR = "/root/testdata/sf0.001"


def test_filter_forms_agree(spark):
    events = nullable_events(spark, SF_DIR)
    chained = events.filter(F.col("genre") == "view").filter(F.col("rating") > 6)
    joined = events.where((F.col("genre") == "view") & (F.col("rating") > 6))
    text = events.filter("genre = 'view' AND rating > 6")
    events.createOrReplaceTempView("evn_forms")
    sql = spark.sql("SELECT * FROM evn_forms WHERE genre = 'view' AND rating > 6")
    assert rows(chained) == rows(joined) == rows(text) == rows(sql) != []


def test_projection_forms_agree(spark):
    events = nullable_events(spark, SF_DIR)
    total = F.col("score") + F.col("event_id")
    forms = [
        events.select("event_id", total.alias("t")),
        events.selectExpr("event_id", "score + event_id AS t"),
        events.withColumn("t", total).select("event_id", "t"),
        events.select("event_id", F.expr("score + event_id").alias("t")).alias("aliased"),
    ]
    assert all(rows(form) == rows(forms[0]) for form in forms)


def test_aggregate_forms_agree(spark):
    events = nullable_events(spark, SF_DIR)
    assert rows(events.select(F.count("genre"))) == rows(events.selectExpr("count(genre)"))
    assert rows(events.groupBy("genre").count()) == rows(events.groupBy("genre").agg(F.count("*")))


def test_frames_are_immutable(spark):
    part = table(spark, SF_DIR, "part")
    before = part.columns
    part.drop("p_name").withColumn("x", F.lit(1)).withColumnRenamed("p_size", "s")
    assert part.columns == before


def test_sorted_order(spark):
    events = nullable_events(spark, SF_DIR)
    found = [(r.rating, r.event_id) for r in QUERIES["sort_asc"](spark, SF_DIR).collect()]
    assert found == sorted(found, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    down = [r.rating for r in QUERIES["sort_desc"](spark, SF_DIR).collect()]
    present = [value for value in down if value is not None]
    assert present == sorted(present, reverse=True) and down[len(present):] == [None] * (len(down) - len(present))
    assert sort_total(events, ["genre"], ["event_id"]).first().genre is None


def test_places_of_a_total_order(spark):
    """Places are those of one global sort, over many partitions and with ties."""
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), (F.col("id") % 3).alias("same"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranked(df, [F.col("same").desc()], ["id"])
        found = placed.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wanted = sorted((row.same, row.id) for row in found)
    wanted.sort(key=lambda x: -x[0])
    assert placed.columns == ["id", "same", "place"]
    assert [(r.same, r.id) for r in sorted(found, key=lambda r: r.place)] == wanted
    assert sorted(r.place for r in found) == list(range(1, 5001))
    assert "Window" not in plan_of(placed) and "SinglePartition" not in plan_of(placed)
    assert ranked(df.limit(0), ["id"], []).collect() == []


def test_sort_spreads_a_hot_value(spark):
    df = spark.range(20000).select(F.lit(1).alias("same"), "id")
    sizes = sort_total(df, ["same"], ["id"]).groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sizes.agg(F.max("count")).first()[0] < 10000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stack_by_name_and_position(spark):
    first = spark.sql("SELECT 1 AS a, 2 AS b")
    second = spark.sql("SELECT 3 AS b, 4 AS a")
    assert rows(stack(first, second)) == [(1, 2), (4, 3)]
    assert rows(stack(first, second, by_name=False)) == [(1, 2), (3, 4)]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("flt_chain", "EqualTo(o_orderstatus,F), GreaterThan(o_totalprice,150000.0)"),
        ("flt_between", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)"),
        ("sql_between_count", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)"),
        ("flt_contains", "StringContains(p_name,small)"),
        ("sql_view_filter", "EqualTo(o_orderstatus,F)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    df = QUERIES[name](spark, SF_DIR)
    assert pushed in df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    "name, schema",
    [
        ("flt_string", "struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>"),
        ("grp_multi_key", "struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>"),
        ("set_distinct", "struct<l_returnflag:string,l_linestatus:string>"),
        ("agg_count_all", "struct<>"),
    ],
)
def test_scans_read_only_the_columns_used(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"src_local"}))
def test_no_pairing_loops_or_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "NestedLoopJoin", "ArrowEval", "BatchEval", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["topk", "topk_nulls", "take_n", "sql_join_top1", "join_topk_back"])
def test_top_k_is_not_a_global_sort(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", [key for key in QUERIES if key.startswith(("proj_", "flt_", "nest_")) and key not in ("proj_aliased_frame", "flt_null_default")])
def test_row_local_queries_have_no_keyed_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_groups_are_shuffled_once_by_key_and_chunk(spark):
    plan = plan_of(QUERIES["grp_collect"](spark, SF_DIR))
    assert "hashpartitioning(o_custkey" in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("name, tables", [("sql_join_group_avg", 3), ("sql_join_top1", 4)])
def test_sql_joins_scan_all_their_tables(spark, name, tables):
    assert plan_of(QUERIES[name](spark, SF_DIR)).count("FileScan parquet") == tables
