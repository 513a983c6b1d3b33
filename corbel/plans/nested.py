"""Nested-document queries.

The documents are built row by row from ``documents``: each line of a text is a
paragraph holding an array of its words. No rows are gathered to make an array,
so array sizes are those of single texts. They are stored once in an application, as
Parquet and (of another shape) as JSON arrays; queries read the fields they use.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.arrays import sort_structs
from corbel.operators.layout import rebalanced
from corbel.operators.nested import (
    ArraySpec,
    explode_array,
    flatten_structs,
    numbered,
    pivot_arrays,
    project_paths,
    pruned_schema,
    rename_display,
    select_accepted,
    used_paths,
)
from corbel.plans import principals
from corbel.plans.registry import query
from corbel.plans.tables import table, texts
from corbel.sources.readers import read_json
from corbel.sources.scratch import stored_once
from corbel.sources.writers import write_json_arrays, write_parquet

SLOTS = 21
HEADER = {
    "doc_id": "enriched.document.doc_id",
    "source": "enriched.document.source",
    "lang": "enriched.document.lang",
}
PARAGRAPHS = "enriched.document.paragraphs"
BY_SIZE = [("size", "DESC"), ("word", "ASC")]
BY_WORD = [("word", "ASC"), ("place.position", "DESC")]


def _word(text, position):
    """A word of a paragraph; none for an empty piece, unnamed if one letter long."""
    size = F.length(text)
    named = F.when(size > 1, text)
    place = F.struct(position.alias("position"), (position + 1).alias("rank"))
    return F.when(size > 0, F.struct(named.alias("word"), size.alias("size"), place.alias("place")))


def _paragraph(line, number):
    return F.struct(
        number.alias("number"),
        F.length(line).alias("size"),
        F.transform(F.split(line, " "), _word).alias("words"),
        F.array(F.lit("plain text")).alias("remarks"),
        F.array(F.struct(number.alias("mark"))).alias("marks"),
    )


def nested_documents(spark, sf_dir):
    """``enriched.document`` structs with an array of paragraphs."""
    paragraphs = F.transform(F.split("text", "\n"), _paragraph)
    document = F.struct("doc_id", "source", "lang", paragraphs.alias("paragraphs"))
    return rebalanced(texts(spark, sf_dir, "doc_id", "source", "lang", "text")).select(
        F.struct(document.alias("document")).alias("enriched")
    )


def stored_documents(spark, sf_dir, paths=("enriched",)):
    """The documents as stored, with these of their fields."""
    documents = nested_documents(spark, sf_dir)
    path = stored_once(
        spark,
        f"{sf_dir.rstrip('/')}/documents.parquet",
        "nested-documents",
        lambda path: write_parquet(documents, path),
    )
    return spark.read.schema(pruned_schema(documents.schema, paths)).parquet(path)


def exploded(spark, sf_dir, *fields, header=tuple(HEADER)):
    """One row per paragraph of the stored documents, with these of its fields only."""
    kept = {name: HEADER[name] for name in header}
    paths = [*kept.values(), *(f"{PARAGRAPHS}.{field}" for field in fields)]
    return explode_array(stored_documents(spark, sf_dir, paths), kept, PARAGRAPHS, "paragraph")


def nested_parts(spark, sf_dir):
    """Parts as a struct within a struct."""
    detail = F.struct("p_size", "p_type").alias("detail")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.struct("p_brand", detail).alias("item")
    )


def words_spec(column, order, slots=SLOTS):
    fields = {"word": "word", "size": "size", "place.position": "position"}
    return ArraySpec(
        column, order, {path: numbered(name, slots) for path, name in fields.items()}
    )


# The paragraphs of all documents, and their words as structs whose fields are
# chosen so that the natural order of the list is the order wanted. An empty
# piece is no word; nulls come first ascending and last descending.
LINES_SQL = """pieces AS (SELECT doc_id, source, lang, string_split(text, chr(10)) AS lines FROM documents),
 numbered AS (SELECT doc_id, source, lang, lines, unnest(range(len(lines))) AS n FROM pieces),
 lines AS (SELECT doc_id, source, lang, CAST(n AS INTEGER) AS number, lines[n + 1] AS line,
   string_split(lines[n + 1], ' ') AS w FROM numbered)"""


def sorted_words_sql(key):
    """Common tables ending in ``sorted``, with the words of a paragraph as ``s``.

    ``key`` is a list of SQL expressions over a piece ``w[i]`` and its position.
    """
    fields = ", ".join(f"k{n}: {expression}" for n, expression in enumerate(key))
    return f"""WITH {LINES_SQL},
 sorted AS (SELECT doc_id, source, lang, number, CAST(length(line) AS INTEGER) AS size,
   list_sort(list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] <> ''),
     lambda i: {{{fields}, p: i - 1,
       word: CASE WHEN length(w[i]) > 1 THEN w[i] END, size: length(w[i])}})) AS s
   FROM lines)"""


NAMED = "CASE WHEN length(w[i]) > 1 THEN 1 ELSE 0 END"
WORD = "CASE WHEN length(w[i]) > 1 THEN w[i] ELSE '' END"
BY_SIZE_SQL = sorted_words_sql(["-length(w[i])", NAMED, WORD])
BY_WORD_SQL = sorted_words_sql([NAMED, WORD, "-i"])
SMALL_FIRST_SQL = sorted_words_sql(["length(w[i])", NAMED, WORD])


def slots_sql(count=SLOTS):
    """The pivoted columns in SQL."""
    return ", ".join(
        f"s[{n}].word AS word_{n}, CAST(s[{n}].size AS INTEGER) AS size_{n}, "
        f"CAST(s[{n}].p AS INTEGER) AS position_{n}"
        for n in range(1, count + 1)
    )


@query(
    "nest_flatten_dash",
    """SELECT p_partkey, p_brand AS "item-p_brand", p_size AS "item-detail-p_size",
         p_type AS "item-detail-p_type" FROM part""",
)
def nest_flatten_dash(spark, sf_dir):
    return flatten_structs(nested_parts(spark, sf_dir), "-")


@query(
    "nest_flatten_structs",
    """SELECT p_partkey, p_brand AS item_p_brand, p_size AS item_detail_p_size,
         p_type AS item_detail_p_type FROM part""",
)
def nest_flatten_structs(spark, sf_dir):
    return flatten_structs(nested_parts(spark, sf_dir))


@query(
    "nest_explode_base",
    f"""WITH {LINES_SQL}
       SELECT doc_id, source, lang, number, CAST(length(line) AS INTEGER) AS size FROM lines""",
)
def nest_explode_base(spark, sf_dir):
    base = exploded(spark, sf_dir, "number", "size")
    return base.select("doc_id", "source", "lang", "paragraph.number", "paragraph.size")


@query(
    "nest_array_sort",
    f"""{SMALL_FIRST_SQL}
       SELECT doc_id, number, array_to_string(list_transform(s, lambda e: coalesce(e.word, '?')), ' ')
         AS words FROM sorted""",
)
def nest_array_sort(spark, sf_dir):
    base = exploded(spark, sf_dir, "number", "words.size", "words.word", header=["doc_id"])
    item = base.schema["paragraph"].dataType["words"].dataType.elementType
    ordered = sort_structs(F.col("paragraph.words"), [("size", "ASC"), ("word", "ASC")], item)
    words = F.array_join(ordered["word"], " ", "?")
    return base.select("doc_id", "paragraph.number", words.alias("words"))


@query(
    "nest_array_comparator",
    f"""WITH {LINES_SQL},
 pieces_of AS (SELECT doc_id, number, w, unnest(range(1, len(w) + 1)) AS i FROM lines),
 words AS (SELECT doc_id, number, i, CASE WHEN length(w[i]) > 1 THEN w[i] END AS word
   FROM pieces_of WHERE w[i] <> '')
       SELECT lines.doc_id, lines.number, coalesce(string_agg(coalesce(word, '?'), ' '
           ORDER BY left(word, 1) ASC NULLS FIRST, word DESC NULLS LAST, i)
         FILTER (WHERE i IS NOT NULL), '') AS words
       FROM lines LEFT JOIN words ON lines.doc_id = words.doc_id AND lines.number = words.number
       GROUP BY 1, 2""",
)
def nest_array_comparator(spark, sf_dir):
    # Two text keys in opposite directions cannot be brought to one.
    base = exploded(spark, sf_dir, "number", "words.word", header=["doc_id"])
    named = base.select(
        "doc_id",
        "paragraph.number",
        F.transform(
            F.array_compact("paragraph.words"),
            lambda item: F.struct(F.left(item["word"], F.lit(1)).alias("initial"), item["word"]),
        ).alias("words"),
    )
    order = [("initial", "ASC"), ("word", "DESC")]
    ordered = sort_structs(F.col("words"), order, named.schema["words"].dataType.elementType)
    words = F.array_join(ordered["word"], " ", "?")
    return named.select("doc_id", "number", words.alias("words"))


@query(
    "nest_array_pivot",
    f"""{BY_SIZE_SQL}
       SELECT doc_id, source, lang, number AS paragraph_number, size AS paragraph_size, {slots_sql()}
       FROM sorted""",
)
def nest_array_pivot(spark, sf_dir):
    fields = ["number", "size", "words.word", "words.size", "words.place.position"]
    paragraphs = flatten_structs(exploded(spark, sf_dir, *fields))
    return pivot_arrays(paragraphs, [words_spec("paragraph_words", BY_SIZE)])


@query(
    "nest_array_pivot_nested",
    f"""{BY_WORD_SQL}
       SELECT doc_id, number AS paragraph_number,
         {", ".join(f"CAST(s[{n}].p + 1 AS INTEGER) AS rank_{n}" for n in range(1, 6))} FROM sorted""",
)
def nest_array_pivot_nested(spark, sf_dir):
    base = exploded(spark, sf_dir, "number", "words.word", "words.place", header=["doc_id"])
    paragraphs = flatten_structs(base)
    ranks = ArraySpec("paragraph_words", BY_WORD, {"place.rank": numbered("rank", 5)})
    return pivot_arrays(paragraphs, [ranks])


@query(
    "nest_array_guard",
    f"""WITH {LINES_SQL}
       SELECT doc_id, source, lang, number AS paragraph_number,
         CAST(length(line) AS INTEGER) AS paragraph_size FROM lines""",
)
def nest_array_guard(spark, sf_dir):
    # An absent array is skipped; one of texts and one without slots are dropped.
    specs = [
        ArraySpec("paragraph_notes", BY_SIZE, {"word": numbered("note", 2)}),
        ArraySpec("paragraph_remarks", BY_SIZE, {"word": numbered("remark", 2)}),
        ArraySpec("paragraph_marks", [("mark", "ASC")]),
    ]
    base = exploded(spark, sf_dir, "number", "size", "remarks", "marks")
    return pivot_arrays(flatten_structs(base), specs)


@query(
    "nest_project_paths",
    'SELECT p_type AS "Part Type", p_size AS units FROM part',
)
def nest_project_paths(spark, sf_dir):
    paths = {"kind": "item.detail.p_type", "units": "item.detail.p_size", "brand": "item.p_brand"}
    projected = project_paths(nested_parts(spark, sf_dir), paths)
    accepted = select_accepted(projected, ["kind", "not_there", "units"])
    return rename_display(accepted, {"kind": "Part Type"})


# Documents of another shape: a line of text is a principal, its words are associations, the
# words before a comma or a full stop disqualifications, and the long words their act types.
PRINCIPALS_DDL = """enriched struct<
  source_text: string,
  organization: struct<
    duns: string, primaryName: string, countryISOAlpha2Code: string,
    currentPrincipals: array<struct<
      number: int, gender: struct<description: string, dnbCode: int>,
      associations: array<struct<
        primaryName: string, duns: string, startDate: string,
        person: struct<name: string, age: int>>>,
      disqualifications: array<struct<endDate: string, actText: string, startDate: string>>,
      disqualifications_actType: array<struct<description: string, dnbCode: int>>>>>>"""
LONG_WORD = 9
#: About what a word and a line take as JSON, without their text.
WORD_BYTES, LINE_BYTES = 64, 128


def _three_digits(number):
    return F.lpad(number.cast("string"), 3, "0")


def _line(line):
    """A line and its words, so that the line is split once for all that is made of them."""
    return F.struct(line.alias("line"), F.split(line, " ").alias("words"))


def _if(condition, value, other=None):
    """A choice of two values: within a lambda, Spark looks up the branches of a CASE one by one."""
    return F.call_function("if", condition, value, F.lit(None) if other is None else other)


def _principal(entry, number):
    line, words = entry["line"], entry["words"]

    def association(text, position):
        size = F.length(text)
        person = F.struct(F.left(text, F.lit(1)).alias("name"), size.alias("age"))
        return _if(
            text != "",
            F.struct(
                _if(size > 1, text).alias("primaryName"),
                position.cast("string").alias("duns"),
                _three_digits(size).alias("startDate"),
                _if(size >= LONG_WORD, person).alias("person"),
            ),
        )

    def disqualified(text, position):
        # The pattern is dear, and most words hold neither sign.
        return _if(_if(text.contains(",") | text.contains("."), text.rlike("[,.]$"), F.lit(False)), position)

    def disqualification(position):
        text = F.get(words, position)
        return F.struct(
            _three_digits(F.length(text)).alias("endDate"),
            text.alias("actText"),
            position.cast("string").alias("startDate"),
        )

    acts = F.transform(F.array_compact(F.transform(words, disqualified)), disqualification)
    kinds = F.transform(
        F.filter(words, lambda x: F.length(x) >= LONG_WORD),
        lambda x: F.struct(x.alias("description"), F.length(x).alias("dnbCode")),
    )
    gender = F.struct(F.left(line, F.lit(1)).alias("description"), F.size(words).alias("dnbCode"))
    return F.struct(
        number.alias("number"),
        gender.alias("gender"),
        F.transform(words, association).alias("associations"),
        acts.alias("disqualifications"),
        kinds.alias("disqualifications_actType"),
    )


def _principals_document():
    """The struct made of a row of ``documents``."""
    organization = F.struct(
        F.col("doc_id").cast("string").alias("duns"),
        F.col("source").alias("primaryName"),
        F.col("lang").alias("countryISOAlpha2Code"),
        F.transform(F.transform(F.split("text", "\n"), _line), _principal).alias("currentPrincipals"),
    )
    return F.struct(F.col("text").alias("source_text"), organization.alias("organization"))


def _principals_bytes():
    """About the length of a document's JSON, from the words and lines that its text falls into."""

    def pieces(separator):
        return F.octet_length("text") - F.octet_length(F.replace("text", F.lit(separator), F.lit(""))) + 1

    return 3 * F.octet_length("text") + WORD_BYTES * pieces(" ") + LINE_BYTES * pieces("\n")


def store_principals(spark, sf_dir, path):
    """The documents as compressed JSON arrays: the names of the fields recur with each word."""
    write_json_arrays(
        texts(spark, sf_dir, "doc_id", "source", "lang", "text"),
        path,
        item=F.struct(_principals_document().alias("enriched")),
        item_bytes=_principals_bytes(),
        rounds=4,
        compression="gzip",
        **{"zlib.compress.level": "FIVE"},
    )


def principals_slots_sql():
    """The columns of the three pivoted arrays in SQL."""
    parts = [
        ("a", "associations", {"primaryName": "word", "duns": "CAST(s.p AS VARCHAR)",
                               "startDate": "lpad(CAST(s.size AS VARCHAR), 3, '0')"}, 21),
        ("t", "disqualifications_disqualificationtype", {"desc": "word"}, 3),
        ("d", "disqualifications", {"endDate": "lpad(CAST(s.size AS VARCHAR), 3, '0')",
                                    "actText": "word", "startDate": "CAST(s.p AS VARCHAR)"}, 3),
    ]
    columns = []
    for array, prefix, fields, count in parts:
        for name, value in fields.items():
            for n in range(1, count + 1):
                slot = f"{array}[{n}]"
                value_sql = value.replace("s.", f"{slot}.") if "s." in value else f"{slot}.{value}"
                columns.append(f"{value_sql} AS currentprincipals_{prefix}_{name.lower()}_{n}")
    return ",\n ".join(columns)


def _words_sql(alias, key, condition):
    fields = ", ".join(f"k{n}: {expression}" for n, expression in enumerate(key))
    return f"""list_sort(list_transform(list_filter(range(1, len(w) + 1), lambda i: {condition}),
     lambda i: {{{fields}, p: i - 1, word: {WORD_OR_NULL if alias == "a" else "w[i]"}, size: length(w[i])}})) AS {alias}"""


WORD_OR_NULL = "CASE WHEN length(w[i]) > 1 THEN w[i] END"


@query(
    "nest_documents",
    f"""WITH {LINES_SQL},
 arrays AS (SELECT doc_id, source, lang, number, line, w,
   {_words_sql("a", [NAMED, WORD, "-length(w[i])"], "w[i] <> ''")},
   {_words_sql("t", ["w[i]"], f"length(w[i]) >= {LONG_WORD}")},
   {_words_sql("d", ["length(w[i])"], "regexp_matches(w[i], '[,.]$')")}
   FROM lines)
       SELECT CAST(doc_id AS VARCHAR) AS duns, source AS "primaryName", lang AS "countryISOAlpha2Code",
         number AS "currentPrincipals_number", left(line, 1) AS "currentPrincipals_gender_description",
         CAST(len(w) AS INTEGER) AS "currentPrincipals_gender_dnbCode",
 {principals_slots_sql()}
       FROM arrays""",
)
def nest_documents(spark, sf_dir):
    path = stored_once(
        spark,
        f"{sf_dir.rstrip('/')}/documents.parquet",
        "principals",
        lambda path: store_principals(spark, sf_dir, path),
    )
    specs = principals.simple_specs()
    declared = T.StructType.fromDDL(PRINCIPALS_DDL)
    used = used_paths(declared, principals.HEADER, principals.PRINCIPALS, "currentPrincipals", specs)
    documents = read_json(
        spark, path, pruned_schema(declared, used), multiLine=True, mode="FAILFAST"
    )
    return principals.flatten_principals(documents, specs)
