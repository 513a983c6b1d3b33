"""Binding of nested records: what fits, what does not, and where."""

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from corbel.plans.storage import NESTED_RECORD
from corbel.sources.records import bind_record

WANTED = T.StructType.fromDDL
STOCK = """named_struct('b', CAST(2 AS SMALLINT), 'a', array(named_struct('y', 1.5F, 'x', 'p', 'z', 0))) AS item,
           map('k', named_struct('n', 1)) AS marks, 7 AS number, 'left out' AS other"""
RECORD = """number BIGINT NOT NULL, item STRUCT<a: ARRAY<STRUCT<x: STRING, y: DOUBLE NOT NULL>>, b: DECIMAL(7,1)>,
            marks MAP<STRING, STRUCT<n: BIGINT>>"""


def fits(have, want):
    """Same names, order and types, and no null allowed where none is declared."""
    if isinstance(want, T.StructType):
        return have.names == want.names and all(
            (y.nullable or not x.nullable) and fits(x.dataType, y.dataType) for x, y in zip(have, want)
        )
    if isinstance(want, T.ArrayType):
        return (want.containsNull or not have.containsNull) and fits(have.elementType, want.elementType)
    if isinstance(want, T.MapType):
        return (want.valueContainsNull or not have.valueContainsNull) and fits(have.valueType, want.valueType)
    return have == want


@pytest.fixture
def stock(spark):
    return spark.sql(f"SELECT {STOCK}")


def test_fields_are_matched_ordered_and_widened(spark, stock):
    record = WANTED(RECORD)
    bound = bind_record(stock, record)
    assert fits(bound.schema, record)
    row = bound.first()
    assert row.number == 7 and row.marks == {"k": Row(n=1)}
    assert row["item"].a == [Row(x="p", y=1.5)] and float(row["item"].b) == 2.0


def test_all_problems_are_named_by_path(spark, stock):
    record = WANTED("""number STRING, item STRUCT<a: ARRAY<STRUCT<x: INT, w: INT>>, b: ARRAY<INT>>,
                       marks MAP<STRING, STRUCT<n: BINARY>>, gone INT, other STRUCT<p: INT>""")
    with pytest.raises(ValueError) as caught:
        bind_record(stock, record)
    for problem in (
        "number: int is no string", "item.a[].x: string is no int", "item.a[].w: missing",
        "item.b: smallint is no array<int>", "marks{}.n: int is no binary", "gone: missing",
        "other: string is no struct<p:int>",
    ):
        assert problem in str(caught.value)


@pytest.mark.parametrize(
    "value, record, path",
    [
        ("CAST(NULL AS INT) AS n", "n INT NOT NULL", "n"),
        ("named_struct('n', CAST(NULL AS INT)) AS s", "s STRUCT<n: INT NOT NULL>", "s.n"),
        ("array(1, NULL) AS a", None, "a[]"),
        ("map('k', CAST(NULL AS INT)) AS m", None, "m{}"),
        ("array(named_struct('n', IF(id = 0, NULL, 1))) AS a", "a ARRAY<STRUCT<n: INT NOT NULL>>", "a[].n"),
    ],
)
def test_nulls_where_none_may_be(spark, value, record, path):
    made = {
        "a[]": T.StructType([T.StructField("a", T.ArrayType(T.IntegerType(), False))]),
        "m{}": T.StructType([T.StructField("m", T.MapType(T.StringType(), T.IntegerType(), False))]),
    }
    wanted = WANTED(record) if record else made[path]
    bound = bind_record(spark.range(1).selectExpr(value), wanted)
    assert fits(bound.schema, wanted)
    with pytest.raises(Exception, match="null in " + path.replace("[", r"\[").replace("{", r"\{")):
        bound.collect()


def test_null_structs_stay_null(spark):
    df = spark.sql("SELECT IF(id = 0, NULL, named_struct('n', id)) AS s FROM range(2)")
    record = WANTED("s STRUCT<n: BIGINT NOT NULL>")
    assert sorted(bind_record(df, record).collect(), key=repr) == sorted(
        [Row(s=None), Row(s=Row(n=1))], key=repr
    )


def test_widening_never_loses_a_value(spark):
    for have, want, fits in [
        ("TINYINT", "BIGINT", True), ("BIGINT", "INT", False), ("INT", "DOUBLE", True),
        ("BIGINT", "DOUBLE", False), ("INT", "FLOAT", False), ("SMALLINT", "FLOAT", True),
        ("FLOAT", "DOUBLE", True), ("DOUBLE", "FLOAT", False), ("INT", "DECIMAL(10,0)", True),
        ("INT", "DECIMAL(10,1)", False), ("DECIMAL(5,2)", "DECIMAL(6,2)", True),
        ("DECIMAL(5,2)", "DECIMAL(6,1)", False), ("STRING", "DATE", False), ("DATE", "DATE", True),
        ("VOID", "STRUCT<a: INT>", True),
    ]:
        df = spark.sql("SELECT NULL AS v" if have == "VOID" else f"SELECT CAST(NULL AS {have}) AS v")
        record = WANTED(f"v {want}")
        if fits:
            assert bind_record(df, record).schema == record and bind_record(df, record).first().v is None
        else:
            with pytest.raises(ValueError, match="is no"):
                bind_record(df, record)


def test_awkward_names_and_empty_frames(spark):
    df = spark.sql("SELECT 1 AS `a.b`, named_struct('c d', 2) AS `s``t`").limit(0)
    record = T.StructType(
        [
            T.StructField("s`t", T.StructType([T.StructField("c d", T.LongType(), False)])),
            T.StructField("a.b", T.LongType(), False),
        ]
    )
    assert bind_record(df, record).schema == record and bind_record(df, record).collect() == []


def test_the_querys_record_keeps_its_nullability(spark):
    record = WANTED(NESTED_RECORD)
    inner = record["enriched"].dataType["document"].dataType
    assert not record["enriched"].nullable and not inner["doc_id"].nullable
