"""The flattener: semantics, properties and the principals document."""

import datetime as dt
import json
import os
import random
import re
from functools import cmp_to_key

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.arrays import sort_steps, sort_structs
from corbel.operators.nested import (
    ArraySpec,
    explode_array,
    flatten_structs,
    leaf_paths,
    numbered,
    pivot_arrays,
    project_paths,
    pruned_schema,
    rename_display,
    select_accepted,
    specs_from_maps,
    used_paths,
)
from corbel.plans import nested
from corbel.plans.catalogue import QUERIES
from corbel.plans.nested import PRINCIPALS_DDL
from corbel.plans.principals import (
    HEADER,
    PRINCIPALS,
    complex_specs,
    flatten_principals,
    simple_specs,
)
from corbel.sources.readers import read_json
from tests.conftest import plan_of, rows

SF_DIR = "/root/testdata/sf0.001"
ITEMS = "array<struct<k:string,d:string,n:int,day:date>>"


def python_order(items, order):
    """Lexicographic, nulls first ascending and last descending, stable."""

    def compare(left, right):
        for name, direction in order:
            a, b = left[name], right[name]
            if a == b:
                continue
            sign = -1 if direction == "DESC" else 1
            if a is None or b is None:
                return sign * (-1 if a is None else 1)
            return sign * (-1 if a < b else 1)
        return 0

    return sorted((item for item in items if item is not None), key=cmp_to_key(compare))


element = st.none() | st.fixed_dictionaries(
    {
        "k": st.none() | st.sampled_from(["a", "b", "é", ""]),
        "d": st.none() | st.sampled_from(["2020", "2021", "2019"]),
        "n": st.none() | st.integers(-3, 3) | st.sampled_from([2**31 - 1, -(2**31)]),
        "day": st.none() | st.dates(dt.date(1969, 12, 30), dt.date(1970, 1, 2)),
    }
)
ORDERS = [
    [("k", "ASC"), ("d", "DESC")],
    [("k", "DESC"), ("n", "ASC")],
    [("k", "ASC"), ("n", "ASC")],
    [("k", "DESC"), ("d", "DESC")],
    [("n", "desc")],
    [("n", "DESC"), ("k", "ASC")],
    [("n", "ASC"), ("day", "DESC"), ("k", "DESC")],
    [("day", "ASC"), ("n", "DESC")],
    [("k", "upwards")],
]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(arrays=st.lists(st.none() | st.lists(element, max_size=12), min_size=1, max_size=20))
def test_sort_matches_python(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), f"id int, items {ITEMS}")
    for order in ORDERS:
        upper = [(name, direction.upper()) for name, direction in order]
        for known in (df.schema["items"].dataType.elementType, None):
            result = df.select("id", sort_structs(F.col("items"), order, known).alias("s"))
            for row in result.collect():
                wanted = arrays[row.id]
                if wanted is None:
                    assert row.s is None
                else:
                    assert [r.asDict() for r in row.s] == python_order(wanted, upper)


@pytest.mark.parametrize("size", [18, 200, 3000])
def test_large_arrays_sort_without_error(spark, size):
    chance = random.Random(size)
    items = [
        {"k": chance.choice("abcdef"), "d": str(chance.randrange(2000, 2030)), "n": n, "day": None}
        for n in range(size)
    ]
    order = [("k", "ASC"), ("d", "DESC")]
    df = spark.createDataFrame([(items,)], f"items {ITEMS}")
    found = df.select(sort_structs(F.col("items"), order).alias("s")).first().s
    assert [r.asDict() for r in found] == python_order(items, order)


@pytest.mark.parametrize("ways", [("ASC", "ASC"), ("ASC", "DESC"), ("DESC", "ASC"), ("DESC", "DESC")])
def test_steps_sort_alike(spark, ways):
    """Projections one after the other sort as the one expression does, and none of texts by a lambda."""
    chance = random.Random(7)
    items = [
        None if chance.random() < 0.2 else {"k": chance.choice([None, "a", "b"]), "d": chance.choice([None, "", "1"]), "n": n, "day": None}
        for n in range(60)
    ]
    df = spark.createDataFrame([(1, items), (2, []), (3, None), (4, [None])], f"id int, items {ITEMS}")
    kind = df.schema["items"].dataType.elementType
    order = [("k", ways[0]), ("d", ways[1])]
    found = df
    for step in sort_steps(order, kind):
        found = found.select("id", step(F.col("items")).alias("items"))
    plan = plan_of(found)
    assert plan.count("sort_array(") == len(set(ways)) and "sort_array(transform(" not in plan
    expected = df.select("id", sort_structs(F.col("items"), order, kind).alias("items"))
    assert rows(found) == rows(expected)
    assert [r.asDict() for r in rows(found)[0][1]] == python_order([i for i in items if i], order)


def test_unknown_sort_field_is_refused(spark):
    df = spark.createDataFrame([(1, [])], f"id int, items {ITEMS}")
    with pytest.raises(ValueError, match="no field 'x.y'"):
        pivot_arrays(df, [ArraySpec("items", [("x.y", "ASC")], {"k": {0: "a"}})])


def test_empty_order_keeps_order_and_removes_nulls(spark):
    items = [{"k": "b"}, None, {"k": "a"}]
    df = spark.createDataFrame([(items,)], f"items {ITEMS}")
    found = df.select(sort_structs(F.col("items"), []).alias("s")).first().s
    assert [r.k for r in found] == ["b", "a"]


def test_pivot_positions(spark):
    rows = [
        (1, [{"k": "b", "d": "1"}, {"k": "a", "d": "2"}]),
        (2, []),
        (3, None),
        (4, [{"k": c, "d": c} for c in "cba"]),
    ]
    df = spark.createDataFrame(rows, f"id int, items {ITEMS}")
    spec = ArraySpec("items", [("k", "ASC")], {"k": numbered("Key", 2), "d": {2: "Third"}})
    found = pivot_arrays(df, [spec])
    assert found.columns == ["id", "Key_1", "Key_2", "Third"]
    assert sorted(map(tuple, found.collect())) == [
        (1, "a", "b", None),
        (2, None, None, None),
        (3, None, None, None),
        (4, "a", "b", "c"),
    ]


def test_pivot_guards(spark):
    df = spark.createDataFrame(
        [(1, ["x"], [{"k": "a"}])], f"id int, texts array<string>, items {ITEMS}"
    )
    order = [("k", "ASC")]
    specs = [
        ArraySpec("missing", order, {"k": numbered("m", 1)}),
        ArraySpec("texts", order, {"k": numbered("t", 1)}),
        ArraySpec("items", order, {"k": numbered("i", 1)}),
    ]
    # A text array is dropped, and the arrays after it are still processed.
    assert pivot_arrays(df, specs).columns == ["id", "i_1"]
    assert pivot_arrays(df, [ArraySpec("items", order)]).columns == ["id", "texts"]
    with pytest.raises(ValueError, match="id is not an array"):
        pivot_arrays(df, [ArraySpec("id", order)])
    with pytest.raises(ValueError, match="share the name"):
        pivot_arrays(df, [ArraySpec("items", order, {"k": {0: "ID"}})])
    with pytest.raises(ValueError, match="two specifications"):
        pivot_arrays(df, [ArraySpec("items", order), ArraySpec("items", order)])
    taken = df.withColumn("items__sorted", F.lit(5))
    found = pivot_arrays(taken, [ArraySpec("items", order, {"k": {0: "first"}})]).first()
    assert (found["items__sorted"], found["first"]) == (5, "a")


def test_spec_validation():
    with pytest.raises(ValueError, match="share the name"):
        ArraySpec("a", (), {"k": {0: "x", 1: "X"}})
    with pytest.raises(ValueError, match="negative"):
        ArraySpec("a", (), {"k": {-1: "x"}})
    with pytest.raises(ValueError, match="without a sort entry"):
        specs_from_maps({"a_b": [("k", "ASC")]}, {"a-b": {"k": {0: "x"}}})
    assert [spec.column for spec in specs_from_maps({"b": (), "a": ()}, {})] == ["b", "a"]


def test_elements_with_maps_are_sorted_by_the_comparator(spark):
    df = spark.sql(
        "SELECT array(named_struct('k', 2, 'm', map('x', 1)), named_struct('k', 1, 'm', map('y', 2))) items"
    )
    found = pivot_arrays(df, [ArraySpec("items", [("k", "ASC")], {"m": numbered("m", 2)})])
    assert found.first().asDict() == {"m_1": {"y": 2}, "m_2": {"x": 1}}


def test_flatten_struct_names(spark):
    df = spark.sql(
        """SELECT 1 AS id, named_struct('email', 'e', 'inner', named_struct('phone', 'p',
             'tags', array('t'), 'm', map('k', 'v'))) AS contact, CAST(NULL AS STRUCT<x: INT>) AS gone"""
    )
    assert leaf_paths(df.schema)[1] == ("contact", "email")
    dashed = flatten_structs(df, "-")
    assert dashed.columns == [
        "id",
        "contact-email",
        "contact-inner-phone",
        "contact-inner-tags",
        "contact-inner-m",
        "gone-x",
    ]
    assert flatten_structs(df).first()["contact_inner_phone"] == "p"
    assert flatten_structs(df).first()["gone_x"] is None


def test_flatten_awkward_names(spark):
    df = spark.sql("SELECT named_struct('b.c', 1, 'd e', 2, 'f`g', 3) AS a")
    assert flatten_structs(df).first().asDict() == {"a_b_c": 1, "a_d e": 2, "a_f`g": 3}
    clash = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b")
    with pytest.raises(ValueError, match="share the name"):
        flatten_structs(clash)


def test_explode_drops_documents_without_elements(spark):
    df = spark.createDataFrame(
        [(1, ["x", None]), (2, []), (3, None)], "id int, items array<string>"
    )
    for computed in (False, True):
        plain = explode_array(df, {"id": "id"}, "items", "item", computed=computed)
        assert sorted(map(tuple, plain.collect()), key=repr) == [(1, "x"), (1, None)]
    outer = explode_array(df, {"id": "id"}, "items", "item", outer=True)
    assert outer.count() == 4


def test_explode_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.sql(
        """SELECT named_struct('id', 1, 'unused', 'u', 'items',
             array(named_struct('k', 'a', 'long_text', 'b'))) AS doc"""
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    found = explode_array(stored, {"id": "doc.id"}, "doc.items", "item").select("id", "item.k")
    assert "struct<doc:struct<id:int,items:array<struct<k:string>>>>" in plan_of(found)
    assert tuple(found.first()) == (1, "a")


def test_computed_arrays_are_computed_once(spark):
    texts = spark.createDataFrame([("a b",)], "t string").select(F.split("t", " ").alias("words"))
    plan = plan_of(explode_array(texts, {}, "words", "word", computed=True))
    assert plan.count("split(") == 1
    wide = explode_array(texts.select(F.struct("words", F.lit(1).alias("id")).alias("d")), {"id": "d.id"}, "d.words", "word")
    # The rows carry the header alone.
    assert "[id#" in plan_of(wide).split("explode(")[1]


def test_mapping_helpers(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 7)) AS a, 'x' AS t")
    projected = project_paths(df, {"seven": "a.b.c", "text": "t"})
    assert projected.first().asDict() == {"seven": 7, "text": "x"}
    assert rename_display(projected, {"seven": "Seven Up"}).columns == ["Seven Up", "text"]
    assert select_accepted(projected, ["text", "nothing"]).columns == ["text"]
    with pytest.raises(ValueError):
        rename_display(projected, {"seven": "text"})


def association(name, start, number, person=None):
    item = {"primaryName": name, "startDate": start, "duns": number}
    return item if person is None else {**item, "person": person}


def principals_file(tmp_path, associations):
    """One document with a principal per list of associations."""
    principals = [
        {
            "fullName": f"P{n}",
            "gender": {"description": "x", "dnbCode": n},
            "disqualifications": [],
            "hobbies": ["h"],
            "associations": items,
        }
        for n, items in enumerate(associations)
    ]
    document = {
        "enriched": {
            "organization": {
                "duns": "1",
                "primaryName": "Acme",
                "countryISOAlpha2Code": "US",
                "currentPrincipals": principals,
            }
        }
    }
    path = tmp_path / "document.json"
    path.write_text(json.dumps(document, indent=2))
    return str(path)


def test_simple_principals(spark, tmp_path):
    items = [
        association("B", "2001", "4"),
        association("A", "2000", "3"),
        association("A", "2005", "2"),
        association(None, "1990", "1"),
        association("A", None, "5"),
    ]
    path = principals_file(tmp_path, [items, []])
    flat = flatten_principals(read_json(spark, path, multiLine=True), simple_specs())
    slots = [name for name in flat.columns if name.startswith("currentprincipals_associations_")]
    assert len(slots) == 63 and slots[21] == "currentprincipals_associations_duns_1"
    assert "currentPrincipals_associations" not in flat.columns
    # An empty array is inferred as an array of texts, and dropped.
    assert "currentPrincipals_disqualifications" not in flat.columns
    assert "currentPrincipals_hobbies" in flat.columns
    full, empty = flat.orderBy("currentPrincipals_fullName").collect()
    found = [full[f"currentprincipals_associations_duns_{n}"] for n in range(1, 7)]
    assert found == ["1", "2", "3", "5", "4", None]
    assert full["duns"] == "1" and full["currentPrincipals_gender_dnbCode"] == 0
    assert all(empty[name] is None for name in slots)


def test_complex_principals(spark, tmp_path):
    items = [
        association("A", "2000", "1", {"age": 40, "name": "Ann"}),
        association("A", "2000", "2", {"age": 50, "name": "Zoe"}),
        association("A", "2000", "3", {"age": 60, "name": None}),
    ]
    path = principals_file(tmp_path, [items])
    flat = flatten_principals(read_json(spark, path, multiLine=True), complex_specs(3)).first()
    prefix = "currentprincipals_associations_person_"
    assert [flat[f"{prefix}name_{n}"] for n in (1, 2, 3)] == ["Zoe", "Ann", None]
    assert [flat[f"{prefix}age_{n}"] for n in (1, 2, 3)] == [50, 40, 60]


def test_disqualifications_fill_their_slots(spark):
    df = spark.sql(
        """SELECT array(named_struct('endDate', '2', 'actText', 'b', 'startDate', 's'),
             named_struct('endDate', '1', 'actText', 'a', 'startDate', 't'))
             AS currentPrincipals_disqualifications"""
    )
    flat = pivot_arrays(df, simple_specs()).first()
    assert flat["currentprincipals_disqualifications_acttext_1"] == "a"
    assert flat["currentprincipals_disqualifications_enddate_3"] is None
    assert len(flat) == 9


def test_flattening_is_one_stage_and_sorts_each_array_once(spark, tmp_path):
    path = principals_file(tmp_path, [[association("A", "2000", "1")]])
    plan = plan_of(flatten_principals(read_json(spark, path, multiLine=True), simple_specs()))
    assert "Exchange" not in plan
    # One array; its two text keys run in opposite directions, each sorted by once.
    assert "array_sort(" not in plan and plan.count("sort_array(") == 2


def test_flattening_runs_on_a_stream(spark, tmp_path):
    path = principals_file(tmp_path, [[association("A", "2000", "7")]])
    schema = read_json(spark, path, multiLine=True).schema
    stream = spark.readStream.schema(schema).option("multiLine", True).json(str(tmp_path))
    flat = flatten_principals(stream, simple_specs())
    query = flat.writeStream.format("memory").queryName("flat_stream").start()
    try:
        query.processAllAvailable()
        found = spark.table("flat_stream").first()
    finally:
        query.stop()
    assert found["currentprincipals_associations_duns_1"] == "7"


# Reading only what is used


def test_pruned_schema_reaches_through_structs_and_arrays():
    schema = T.StructType.fromDDL(
        "a STRUCT<b: ARRAY<ARRAY<STRUCT<c: INT, d: STRUCT<e: INT, f: INT>>>>, g: INT>, h MAP<STRING, INT>, i INT"
    )
    assert pruned_schema(schema, ["h", "a.b.d.f"]) == T.StructType.fromDDL(
        "a STRUCT<b: ARRAY<ARRAY<STRUCT<d: STRUCT<f: INT>>>>>, h MAP<STRING, INT>"
    )
    assert pruned_schema(schema, ["a.b.c", "a"]) == T.StructType([schema["a"]])
    for path in ("x", "a.x", "a.b.d.x", "i.x", "h.x"):
        with pytest.raises(ValueError):
            pruned_schema(schema, [path])


def test_used_paths_leave_out_what_is_dropped():
    schema = T.StructType.fromDDL(
        """top STRUCT<id: INT, big: STRING, people: ARRAY<STRUCT<
             name: STRING, at: STRUCT<x: INT, y: INT>, tags: ARRAY<STRING>,
             jobs: ARRAY<STRUCT<title: STRING, since: INT, pay: INT, place: STRUCT<city: STRING>>>,
             notes: ARRAY<STRUCT<note: STRING>>>>>"""
    )
    specs = [
        ArraySpec("p_jobs", [("since", "DESC")], {"place.city": numbered("city", 2)}),
        ArraySpec("p_notes", [("note", "ASC")]),
        ArraySpec("p_tags"),
    ]
    used = used_paths(schema, {"id": "top.id"}, "top.people", "p", specs)
    assert used == [
        "top.id", "top.people.name", "top.people.at.x", "top.people.at.y",
        "top.people.jobs.since", "top.people.jobs.place.city",
    ]
    for array in ("top.id", "top.gone", "gone.people", "top.people.tags"):
        with pytest.raises(ValueError):
            used_paths(schema, {}, array, "p", specs)


def test_pruned_documents_flatten_alike(spark, tmp_path):
    """Skipping unused fields of the stored documents changes no column and no row."""
    items = [association("B", "2001", "4", {"age": 1, "name": "x"}), association("A", "2000", "3")]
    path = principals_file(tmp_path, [items, []])
    declared = T.StructType.fromDDL(PRINCIPALS_DDL)
    specs = simple_specs()
    used = used_paths(declared, HEADER, PRINCIPALS, "currentPrincipals", specs)
    pruned = pruned_schema(declared, used)
    assert "person" not in pruned.simpleString() and "source_text" not in pruned.simpleString()
    whole = flatten_principals(read_json(spark, path, declared, multiLine=True), specs)
    less = flatten_principals(read_json(spark, path, pruned, multiLine=True), specs)
    assert less.columns == whole.columns and rows(less) == rows(whole) != []


@pytest.mark.parametrize(
    "name, read, skipped",
    [
        ("nest_explode_base", ["number", "size", "lang"], ["words", "word", "remarks", "place"]),
        ("nest_array_sort", ["number", "size", "word"], ["place", "lang", "remarks"]),
        ("nest_array_comparator", ["number", "word"], ["place", "size", "remarks"]),
        ("nest_array_pivot_nested", ["rank", "position"], ["size", "remarks", "lang"]),
        ("nest_array_guard", ["remarks", "marks"], ["words", "word"]),
        ("nest_documents", ["currentPrincipals", "startDate"], ["person", "source_text"]),
    ],
)
def test_scans_read_only_the_fields_used(spark, name, read, skipped):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    fields = set(re.findall(r"(\w+):", schema))
    assert fields >= set(read) and not fields & set(skipped)


def test_stored_principals_are_small(spark, tmp_path):
    """The JSON takes many times the disk of the texts unless it is compressed."""
    chance = random.Random(4)

    def word():
        return "".join(chance.choices("etaoinshr", k=chance.randint(1, 11))) + chance.choice(["", "", ",", ".", ".\r"])

    texts = [None, "", " ", "a. \n, b"]
    texts += ["\n".join(" ".join(word() for _ in range(40)) for _ in range(9)) for _ in range(200)]
    df = spark.createDataFrame(
        [(n, text, "en", f"s{n % 3}") for n, text in enumerate(texts)], "doc_id long, text string, lang string, source string"
    )
    folder = tmp_path / "documents.parquet"
    df.coalesce(1).write.parquet(str(folder))
    found = QUERIES["nest_documents"](spark, str(tmp_path))
    files = [file.removeprefix("file://") for file in found.inputFiles()]
    taken = sum(part.stat().st_size for part in folder.glob("part-*"))
    assert files and sum(map(os.path.getsize, files)) < 4 * taken
    lines = [(str(n), i, line) for n, text in enumerate(texts) if text is not None for i, line in enumerate(text.split("\n"))]
    kept = found.select("duns", "currentPrincipals_number", "currentPrincipals_gender_dnbCode").collect()
    assert sorted(map(tuple, kept)) == sorted((n, i, len(line.split(" "))) for n, i, line in lines)
    # A line break of another kind after a full stop does not hide it.
    acts = found.select(*[f"currentprincipals_disqualifications_acttext_{n}" for n in (1, 2, 3)], "duns", "currentPrincipals_number")
    ends = {(row[3], row[4]): [text for text in row[:3] if text] for row in acts.collect()}
    for n, i, line in lines:
        signed = sorted((w for w in line.split(" ") if w.rstrip("\r").endswith((",", "."))), key=lambda w: f"{len(w):03}")
        assert ends[n, i] == signed[:3]


@pytest.mark.parametrize("text", ["\n" * 500, "a " * 500, "abcdefghijkl. " * 500, "Of the. And words, more\n" * 90])
def test_length_of_principals_is_about_known(spark, text):
    """Files are bounded by it, whatever words and lines the texts hold."""
    df = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    length = F.octet_length(F.to_json(F.struct(nested._principals_document().alias("enriched"))))
    found = df.select(length.alias("real"), nested._principals_bytes().alias("about")).first()
    assert found.about / 3 < found.real < found.about * 3


def test_opposite_text_keys_need_no_comparator(spark):
    plan = plan_of(QUERIES["nest_array_comparator"](spark, SF_DIR))
    assert "array_sort(" not in plan and plan.count("sort_array(") == 2


def test_the_last_sort_stands_in_no_lambda(spark):
    """Around a sort a lambda would have it interpreted too."""
    for name in ("nest_array_comparator", "nest_array_sort"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "array_join(sort_array(" in plan and "transform(transform(sort_array(" not in plan
