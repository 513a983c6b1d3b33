"""Aggregates on nulls, ties, copies and hot groups."""

import pytest
from pyspark.sql import functions as F

from corbel.operators.aggregates import (
    collect_groups,
    corr_with_zeros,
    distinct_sketches,
    integer_mean,
    latest_per_key,
    least_row,
    merged_distinct,
)
from corbel.plans.catalogue import QUERIES
from corbel.plans.tables import table
from tests.conftest import plan_of, rows


def one(df, *columns):
    return tuple(df.agg(*columns).first())


def test_integer_mean_truncates_and_counts_nulls(spark):
    df = spark.createDataFrame([(5,), (None,), (6,), (None,)], "x long")
    assert one(df, integer_mean(F.col("x"))) == (2,)
    assert one(df.selectExpr("-x AS x"), integer_mean(F.col("x"))) == (-2,)
    assert one(df.filter("false"), integer_mean(F.col("x"))) == (None,)


def test_means_and_sums_keep_small_and_large_values(spark):
    small = spark.createDataFrame([(0.001,), (0.002,)], "x double")
    assert one(small, F.avg("x"))[0] == pytest.approx(0.0015)
    large = spark.createDataFrame([(1e17,), (3e17,), (None,)], "x double")
    assert one(large, F.sum("x"), F.avg("x")) == (4e17, 2e17)


def test_two_correlations(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, None), (3.0, 2.0), (4.0, 1.0)], "a double, b double")
    zeros, pairs = one(df, corr_with_zeros(F.col("a"), F.col("b")), F.corr("a", "b"))
    assert zeros == pytest.approx(df.stat.corr("a", "b"))
    assert pairs == pytest.approx(-1.0) or pairs < zeros


def test_counts_with_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",), (None,)], "g string")
    assert one(df, F.count("g"), F.count("*"), F.count_distinct("g")) == (3, 5, 2)
    assert df.distinct().count() == 3
    assert rows(df.groupBy("g").count()) == sorted([("a", 2), ("b", 1), (None, 2)], key=repr)


def test_product_and_reduce(spark):
    numbers = spark.range(1, 11)
    assert one(numbers, F.product("id")) == (3628800.0,)


def test_least_row_settles_ties(spark):
    df = spark.createDataFrame([(3, 1.5), (2, 1.5), (1, 9.0)], "id int, price double")
    assert df.agg(least_row(["price", "id"], ["price", "id"]).alias("r")).first().r.id == 2


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "old", 5), (1, "new", 9), (2, "only", None)], "k int, title string, day int"
    )
    assert rows(latest_per_key(df, ["k"], ["day"], ["title"])) == [(1, "new"), (2, "only")]


def test_groups_are_whole_and_bounded(spark):
    # One key has a third of all rows, one row of another has a thousand copies.
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    many = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    copies = spark.range(1000).select(F.lit("copied").alias("k"), F.lit(1).cast("long").alias("v"))
    nulls = spark.range(4).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(many).unionByName(copies).unionByName(nulls)
    groups = collect_groups(df, ["k"], ["v"], F.col("v"), width=100, fold=True)
    back = groups.select("k", F.explode("members").alias("m")).select("k", "m.v", "m.copies")
    assert rows(back) == rows(df.groupBy("k", "v").agg(F.count("*").alias("copies")))
    sizes = groups.groupBy("k").agg(F.count("*").alias("chunks"), F.max(F.size("members")).alias("most"))
    found = {row.k: (row.chunks, row.most) for row in sizes.collect()}
    assert found["hot"] == (30, 100)
    assert found["copied"] == (1, 1) and found[None] == (1, 4)
    # The members of these are 500 apart, and so each has a chunk of its own.
    assert all(found[f"k{n}"] == (10, 1) for n in range(500))


def test_names_with_dots(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "`k.x` string, `v.y` int")
    groups = collect_groups(df, ["k.x"], ["v.y"], F.col("`v.y`"), width=1).select("chunk", F.size("members"))
    assert sum(row[1] for row in groups.collect()) == 2
    assert rows(latest_per_key(df, ["k.x"], ["v.y"], ["v.y"])) == [("a", 2)]


def test_group_members_are_sorted(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2)], "k int, v int")
    assert [m.v for m in collect_groups(df, ["k"], ["v"], F.col("v")).first().members] == [1, 2, 3]


def test_merged_sketches_are_close(spark):
    """Sketches merged over groups estimate the distinct values of all, within three errors."""
    df = spark.range(200_000).selectExpr(
        "id % 7 AS store", "id % 3 AS shop", "IF(id % 11 = 0, NULL, id % 60000) AS v", "id % 100 AS w"
    )
    stored = distinct_sketches(df, ["store", "shop"], ["v", "w"])
    whole = merged_distinct(stored, [], ["v", "w"]).first()
    exact = df.agg(F.count_distinct("v"), F.count_distinct("w")).first()
    assert abs(whole.v - exact[0]) <= 3 * 0.8 / 64 * exact[0] and whole.w == exact[1]
    by_store = merged_distinct(stored, ["store"], ["w"])
    assert by_store.columns == ["store", "w"] and rows(by_store) == [(n, 100) for n in range(7)]
    assert merged_distinct(distinct_sketches(df.limit(0), ["store"], ["v"]), ["store"], ["v"]).collect() == []


@pytest.mark.parametrize("columns", [["l_partkey", "l_suppkey"]])
def test_sketch_query_at_larger_scale(spark, columns):
    sf_dir = "/root/testdata/sf0.1"
    found = {row.l_returnflag: row for row in QUERIES["agg_sketch_distinct"](spark, sf_dir).collect()}
    exact = table(spark, sf_dir, "lineitem").agg(*[F.count_distinct(x).alias(x) for x in columns]).first()
    for column in columns:
        assert abs(found[None][column] - exact[column]) <= 3 * 0.8 / 256 * exact[column] + 1


def test_estimates_stand_beside_exact_counts(spark):
    """Parts, suppliers and flags are all counted, and no registers are kept for each key."""
    sf_dir = "/root/testdata/sf0.1"
    df = QUERIES["agg_approx_distinct"](spark, sf_dir)
    names = {"parts": "l_partkey", "suppliers": "l_suppkey", "flags": "l_returnflag"}
    exact = table(spark, sf_dir, "lineitem").agg(
        *[F.count_distinct(column).alias(name) for name, column in names.items()]
    )
    found = df.first().asDict()
    assert found == {**exact.first().asDict(), "parts_close": True, "suppliers_close": True}
    grouped = [x for x in plan_of(df).splitlines() if "approx_count_distinct" in x and "keys=[]" not in x]
    assert not grouped
