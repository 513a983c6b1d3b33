"""Join operators against Spark's own joins and brute force."""

import random

import pytest
from pyspark.errors import AnalysisException
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
from corbel.plans.catalogue import QUERIES
from tests.conftest import plan_of, rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parcels(spark):
    """Couriers, depots and delivery zones; each join type has unmatched rows."""
    couriers = spark.createDataFrame(
        [
            (31, "kit", [610], 9004),
            (35, "lou", None, None),
            (38, "mo", [640, 620, 640], 9001),
            (44, "pat", [620, 699], 9077),
            (52, "sky", [], 9004),
            (57, "val", [630], 9002),
        ],
        "ref long, courier string, zones array<long>, depot long",
    )
    depots = spark.createDataFrame(
        [(9001, "quay"), (9002, "mill"), (9003, "hill"), (9004, "dock")], "ref long, place string"
    )
    zones = spark.createDataFrame(
        [(600, "old town"), (610, "harbour"), (620, "fields"), (640, "station")],
        "zone long, district string",
    )
    return couriers, depots, zones


@pytest.fixture(scope="module")
def skewed(spark):
    """Two tables in which one key holds a third of the rows, and nulls."""
    chance = random.Random(3)

    def key(hot):
        return None if chance.random() < 0.05 else (hot if chance.random() < 0.35 else chance.randrange(60))

    left = spark.createDataFrame([(n, key(7)) for n in range(400)], "l int, lk int")
    right = spark.createDataFrame([(n, key(9)) for n in range(300)], "r int, rk int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_outer", "right_outer", "outer", "full"])
def test_outer_join_is_sparks(skewed, how):
    left, right = skewed
    wanted = left.join(right, left["lk"] == right["rk"], how)
    found = outer_join(left, right, {"lk": "rk"}, how)
    assert found.columns == wanted.columns and rows(found) == rows(wanted)
    assert "FullOuter" not in plan_of(found)


@pytest.mark.parametrize("operator, how", [(semi_join, "left_semi"), (anti_join, "left_anti")])
def test_existence_is_sparks(skewed, operator, how):
    left, right = skewed
    wanted = left.join(right, left["lk"] == right["rk"], how)
    assert rows(operator(left, right, {"lk": "rk"})) == rows(wanted)


def test_outer_join_on_two_keys_with_nulls(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (3, 4, "c")], "`l.x` int, ly int, t string")
    right = spark.createDataFrame([(1, 2, "B"), (None, 2, "N"), (1, None, "A")], "rx int, ry int, u string")
    wanted = left.join(right, (left["`l.x`"] == right["rx"]) & (left["ly"] == right["ry"]), "full")
    assert rows(outer_join(left, right, {"l.x": "rx", "ly": "ry"}, "full")) == rows(wanted)


def test_outer_join_of_a_frame_with_itself(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 9)], "id int, boss int")
    chiefs = staff.select(F.col("id").alias("chief"), F.col("boss").alias("chief_boss"))
    found = rows(outer_join(staff, chiefs, {"boss": "chief"}, "full"))
    assert found == sorted(
        [
            (2, 1, 1, None),
            (3, 1, 1, None),
            (1, None, None, None),
            (4, 9, None, None),
            (None, None, 2, 1),
            (None, None, 3, 1),
            (None, None, 4, 9),
        ],
        key=repr,
    )


def test_outer_join_of_two_keys_with_one(spark):
    left = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    right = spark.createDataFrame([(1,), (2,)], "x int")
    wanted = left.join(right, (left["a"] == right["x"]) & (left["b"] == right["x"]), "full")
    assert rows(outer_join(left, right, {"a": "x", "b": "x"}, "full")) == rows(wanted)


def final_plan(spark, df):
    """The plan as it ran with no broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        executed = df._jdf.queryExecution().executedPlan()
        executed.execute().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return executed.toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["join_full", "join_pairs_outer"])
def test_outer_join_shuffles_each_side_once(spark, name):
    """Each side is read once whole and once for its keys; the keys are aggregated once."""
    plan = final_plan(spark, QUERIES[name](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 4
    assert plan.count("Exchange hashpartitioning") == 3 + plan.count("ReusedExchange")
    assert plan.count("SortMergeJoin") == 1 and plan.count("ReusedExchange") == 1


def test_left_join_reads_what_it_needs(spark):
    plan = final_plan(spark, QUERIES["join_left"](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 4 and "ReusedExchange" not in plan


def test_full_membership_join_scans_and_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["join_array_outer"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") <= 5 and plan.count("Exchange hashpartitioning") <= 8
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_outer_join_of_keys_with_maps_and_other_widths(spark):
    """A row's map takes no part in its mark, and keys of other widths meet."""
    left = spark.sql("SELECT * FROM VALUES (1, map('a', 1)), (NULL, map('b', 2)), (7, NULL) AS t(lk, m)")
    right = spark.sql("SELECT * FROM VALUES (1L, 'x'), (1L, 'y'), (NULL, 'n'), (8L, 'z') AS t(rk, v)")
    for how in ("left", "right", "full"):
        wanted = left.join(right, left["lk"] == right["rk"], how)
        assert rows(outer_join(left, right, {"lk": "rk"}, how)) == rows(wanted)


@pytest.mark.parametrize("empty", ["left", "right", "both"])
def test_outer_join_with_an_empty_side(skewed, empty):
    left, right = skewed
    left = left.limit(0) if empty in ("left", "both") else left
    right = right.limit(0) if empty in ("right", "both") else right
    for how in ("left", "right", "full"):
        wanted = left.join(right, left["lk"] == right["rk"], how)
        assert rows(outer_join(left, right, {"lk": "rk"}, how)) == rows(wanted)


def test_join_on_two_keys_by_name(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, t string")
    right = spark.createDataFrame([(1, 2)], "x int, y int")
    assert rows(semi_join(left, right, ["x", "y"])) == [(1, 2, "b")]
    assert rows(anti_join(left, right, ["x", "y"])) == [(1, 1, "a")]


def test_outer_join_refuses_shared_names_and_unknown_kinds(parcels):
    couriers, depots, _ = parcels
    with pytest.raises(ValueError, match="share the name"):
        outer_join(couriers, depots, {"depot": "ref"}, "left")
    with pytest.raises(ValueError, match="unknown"):
        outer_join(couriers.drop("ref"), depots, {"depot": "ref"}, "cross")


def test_duplicate_names(parcels):
    couriers, depots, _ = parcels
    joined = couriers.join(depots, couriers["depot"] == depots["ref"])
    with pytest.raises(AnalysisException, match="AMBIGUOUS"):
        joined.select("ref")
    assert joined.drop(depots["ref"]).columns == ["ref", "courier", "zones", "depot", "place"]
    used = using_join(couriers.drop("ref"), depots, {"depot": "ref"})
    assert used.columns == ["depot", "courier", "zones", "place"]
    kept = suffixed_join(couriers, depots, {"depot": "ref"})
    assert kept.columns == ["ref", "courier", "zones", "depot", "ref_right", "place"]
    assert kept.filter("depot != ref_right").count() == 0 and kept.count() == 4


def test_pair_join_absent_side_is_null(parcels):
    couriers, depots, _ = parcels
    pairs = pair_join(couriers, depots, {"depot": "ref"}, "full")
    assert pairs.columns == ["_1", "_2"]
    shape = rows(pairs.select("_1.courier", "_2.place", F.col("_1").isNull(), F.col("_2").isNull()))
    assert shape == sorted(
        [
            ("kit", "dock", False, False),
            ("sky", "dock", False, False),
            ("mo", "quay", False, False),
            ("val", "mill", False, False),
            ("lou", None, False, True),
            ("pat", None, False, True),
            (None, "hill", True, False),
        ],
        key=repr,
    )
    assert pair_join(couriers, depots, {"depot": "ref"}).count() == 4


def test_membership_join(parcels):
    couriers, _, zones = parcels
    found = membership_join(couriers, zones, "zones", "zone")
    naive = couriers.join(zones, F.expr("array_contains(zones, zone)"))
    assert found.columns == naive.columns and rows(found) == rows(naive)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_membership_join_matches_brute_force(spark, how):
    chance = random.Random(11)

    def array():
        if chance.random() < 0.1:
            return None
        return [None if chance.random() < 0.1 else chance.randrange(12) for _ in range(chance.randrange(6))]

    lefts = [(n, array()) for n in range(60)]
    # Members repeat, some are null and some are in no array.
    rights = [(n, None if chance.random() < 0.1 else chance.randrange(16)) for n in range(30)]
    wanted = [
        (*l, *r) for l in lefts for r in rights if l[1] is not None and r[1] is not None and r[1] in l[1]
    ]
    if how in ("left", "full"):
        wanted += [(*l, None, None) for l in lefts if l[0] not in {w[0] for w in wanted if w[0] is not None}]
    if how in ("right", "full"):
        met = {w[2] for w in wanted}
        wanted += [(None, None, *r) for r in rights if r[0] not in met]
    left = spark.createDataFrame(lefts, "l int, items array<int>")
    right = spark.createDataFrame(rights, "r int, member int")
    found = membership_join(left, right, "items", "member", how, ["l"])
    assert rows(found) == sorted(wanted, key=repr)
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    pairs = membership_pairs(left, right, "items", "member", how, ["l"])
    assert rows(pairs.select("_1.*", "_2.*")) == sorted(wanted, key=repr)


def test_membership_join_needs_a_key_for_left_rows(parcels):
    couriers, _, zones = parcels
    with pytest.raises(ValueError, match="left_key"):
        membership_join(couriers, zones, "zones", "zone", "full")
    with pytest.raises(ValueError, match="unknown"):
        membership_join(couriers, zones, "zones", "zone", "cross")


def test_top_detail(spark):
    pay = spark.createDataFrame([(n, n * 10 % 7) for n in range(30)], "k int, pay int")
    titles = spark.createDataFrame([(n % 30, f"t{n % 4}", n) for n in range(200)], "k int, title string, day int")
    top = top_rows(pay, [F.col("pay").desc(), F.col("k")], 3)
    assert "TakeOrderedAndProject" in plan_of(top)
    wanted = titles.join(top, "k")
    assert rows(top_detail(titles, top, 3, ["k"])) == rows(wanted)
