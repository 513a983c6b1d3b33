"""Column functions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corbel.functions.arrays import element, tokens
from corbel.functions.dates import age_in_years, parse_dates
from corbel.functions.paths import column_at, quoted, require_distinct
from corbel.functions.predicates import (
    alternation,
    any_of,
    contains_any,
    extracts,
    matches_any,
    or_zero,
)


def values(spark, items, column, kind="string"):
    df = spark.createDataFrame([(n, item) for n, item in enumerate(items)], f"n int, x {kind}")
    return [row.y for row in df.select("n", column.alias("y")).orderBy("n").collect()]


X = None


@pytest.fixture(autouse=True, scope="module")
def column_under_test(spark):
    """A column can only be made once there is a session."""
    global X
    X = F.col("x")


def test_any_of(spark):
    assert values(spark, ["a", "b"], any_of([])) == [False, False]
    assert values(spark, ["a", "b", None], any_of([X == "a", X == "c"])) == [True, False, None]


def test_lists_match_literally(spark):
    names = ["a.c", "abc", "a|c", None, ""]
    wanted = [True, False, False, None, False]
    assert values(spark, names, contains_any(X, ["a.c"])) == wanted
    assert values(spark, names, matches_any(X, ["a.c"])) == wanted
    assert values(spark, names, matches_any(X, [])) == [False] * 5
    assert values(spark, names, extracts(X, alternation(["a.c", "a|c"]))) == [True, False, True, None, False]


def test_or_zero(spark):
    assert values(spark, [None, 3], or_zero(X), "long") == [0, 3]


def test_two_digit_years(spark):
    texts = ["12-Jun-98", "01-Jan-50", "01-Jan-28", "29-Feb-00", "nonsense", None, ""]
    assert values(spark, texts, parse_dates(X, "dd-MMM-yy", pivot=2028)) == [
        dt.date(1998, 6, 12),
        dt.date(1950, 1, 1),
        dt.date(2028, 1, 1),
        dt.date(2000, 2, 29),
        None,
        None,
        None,
    ]


def test_several_formats(spark):
    formats = ["dd-MMM-yy", "yyyy-MM-dd", "MMM d yyyy"]
    texts = ["12-Jun-98", "1969-07-20", "Jan 1 2000", "Jan 31 2000", "1/2/3"]
    assert values(spark, texts, parse_dates(X, formats, pivot=2050)) == [
        dt.date(1998, 6, 12),
        dt.date(1969, 7, 20),
        dt.date(2000, 1, 1),
        dt.date(2000, 1, 31),
        None,
    ]


@pytest.mark.parametrize(
    "fmt", ["yyyy-MM-dd", "MMM d yyyy", "dd-MMM-yy", "d/M/y", "yyyyMMdd", "d MMMM yyyy", "yyyy[-MM-dd]", "dd.MM.yyyy", "'on' yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"]
)
def test_shapes_reject_nothing_that_parses(spark, fmt):
    days = [dt.date(1999, 1, 31), dt.date(2024, 2, 29), dt.date(10000 - 1, 12, 1)]
    df = spark.createDataFrame([(day,) for day in days], "day date")
    written = [row[0] for row in df.select(F.date_format("day", fmt)).collect()]
    odd = [" " + written[0], written[0] + " ", "+" + written[0], "", "x", written[0].upper(), "1-2-3", None]
    texts = written + odd + ["2000-1-1", "Jan 1 2000", "12-Jun-98", "19990131", "1/2/2000"]
    assert values(spark, texts, parse_dates(X, fmt)) == values(spark, texts, F.try_to_date(X, fmt))


def test_dates_under_the_legacy_parser(spark):
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
    try:
        texts = ["12-Jun-98 x", "12-Jun-98", "x", None]
        found = values(spark, texts, parse_dates(X, "dd-MMM-yy"))
        assert found == values(spark, texts, F.try_to_date(X, "dd-MMM-yy"))
        assert found[0] == found[1] == dt.date(1998, 6, 12)
    finally:
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")


def test_age(spark):
    days = [dt.date(2001, 1, 1), None]
    assert values(spark, days, age_in_years(X, dt.date(2002, 1, 1)), "date") == [1.0, None]
    assert values(spark, days, age_in_years(X), "date")[0] > 20


def test_tokens_and_elements(spark):
    titles = ["Love, Actually", "", None]
    assert values(spark, titles, tokens(X)) == [["Love", "", "Actually"], [""], None]
    assert values(spark, titles, element(tokens(X), 2)) == ["Actually", None, None]
    assert values(spark, titles, F.size(tokens(X)))[:2] == [3, 1]
    assert values(spark, titles, F.array_contains(tokens(X), "Love")) == [True, False, None]


def test_initcap_words_start_after_spaces(spark):
    assert values(spark, ["ford (uk) mercedes-benz"], F.initcap(X)) == ["Ford (uk) Mercedes-benz"]


def test_regexp_replace_replaces_all(spark):
    assert values(spark, ["vw and vw"], F.regexp_replace(X, "vw", "car")) == ["car and car"]


def test_paths(spark):
    df = spark.sql("SELECT named_struct('x.y', 1, 'z', named_struct('w', 2)) AS a")
    assert df.select(column_at(["a", "x.y"])).first()[0] == 1
    assert df.select(column_at("a.z.w")).first()[0] == 2
    assert quoted("a`b") == "`a``b`"
    assert require_distinct(["a", "b"]) == ["a", "b"]
    with pytest.raises(ValueError):
        require_distinct(["a", "a"])


def test_null_functions(spark):
    df = spark.createDataFrame([(None, 5.0), (50, 5.0), (40, None)], "r int, i double")
    found = df.selectExpr("ifnull(r, i * 10)", "nvl(r, i * 10)", "nullif(r, i * 10)", "nvl2(r, i * 10, 0.0)")
    assert [tuple(row) for row in found.collect()] == [
        (50.0, 50.0, None, 0.0),
        (50.0, 50.0, None, 50.0),
        (40.0, 40.0, 40, None),
    ]
    assert df.na.drop().count() == 1 and df.na.drop(how="all").count() == 3
    assert df.na.fill(0, ["i"]).collect()[2].i == 0.0
    assert df.na.fill({"r": 1, "i": 2}).collect()[0].r == 1
