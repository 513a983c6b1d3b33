"""One key holds a third of all rows: the final plans split its partition."""

import pytest
from pyspark.sql import functions as F

from corbel.operators.aggregates import collect_groups
from corbel.operators.joins import membership_join, outer_join, semi_join

ROWS = 200_000
SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture(autouse=True)
def limits(spark):
    before = {name: spark.conf.get(name) for name in SMALL_LIMITS}
    for name, value in SMALL_LIMITS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def tables(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    text = F.sha2(F.col("id").cast("string"), 256)
    big = spark.range(ROWS).select(F.col("id").alias("b"), hot.alias("bk"), text.alias("pad"))
    small = spark.range(4000).select(F.col("id").alias("sk"), text.alias("w"))
    return big, small


def run(df):
    """Row count, and the physical plan after execution."""
    executed = df._jdf.queryExecution().executedPlan()
    count = executed.execute().count()
    return count, executed.toString().split("== Initial Plan ==")[0]


def hot_share(rows):
    return ROWS // 3 < rows


@pytest.mark.parametrize("how, big_first", [("left", True), ("left", False), ("right", True), ("full", True), ("full", False)])
def test_outer_joins(tables, how, big_first):
    big, small = tables
    found = (
        outer_join(big, small, {"bk": "sk"}, how)
        if big_first
        else outer_join(small, big, {"sk": "bk"}, how)
    )
    count, plan = run(found)
    assert hot_share(count) and "SortMergeJoin(skew=true)" in plan


def test_existence(tables):
    big, small = tables
    count, plan = run(semi_join(big, small, {"bk": "sk"}))
    assert hot_share(count) and "SortMergeJoin(skew=true)" in plan
    # The hot side as the right one is one row per key.
    count, plan = run(semi_join(small, big, {"sk": "bk"}))
    assert count == 4000 and "skew=true" not in plan


def test_membership(tables):
    big, small = tables
    arrays = big.select("b", F.array("bk", F.col("b") % 5000).alias("keys"))
    count, plan = run(membership_join(arrays, small, "keys", "sk", "full", ["b"]))
    assert hot_share(count) and "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("how", ["left", "full"])
def test_null_keys_are_dealt_out(tables, how):
    """Two thirds of the keys are null: no task gets more than a few of the marks' rows."""
    big, small = tables
    bare = big.withColumn("bk", F.when(F.col("b") % 3 == 0, F.col("bk")))
    found = outer_join(bare, small, {"bk": "sk"}, how)
    count, plan = run(found.withColumn("task", F.spark_partition_id()))
    sizes = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < count * 0.7
    naive = bare.join(small, bare["bk"] == small["sk"], how)
    assert count == naive.count() and "FullOuter" not in plan


def test_groups(tables):
    big, _ = tables
    groups = collect_groups(big, ["bk"], ["b", "pad"], F.col("b"), width=5000)
    _, plan = run(groups)
    assert plan.count("Exchange hashpartitioning") == 1
    hot = groups.filter("bk = 7").select(F.size("members").alias("n")).collect()
    assert len(hot) == ROWS // 5000
    assert max(row.n for row in hot) < 5000
