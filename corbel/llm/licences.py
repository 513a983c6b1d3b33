"""Licence notices in documents, found by rare words at the right distance.

Every notice is indexed by word and position. Of each file's licence words those with
the highest inverse document frequency are looked up; a notice's place is where the
postings of its rare words agree, position less position in the notice. There the
notice's key phrase must stand word for word, and at least half of its words must
stand around it. A key phrase is mandatory, so its words are the ones to look up and
no place is lost. Built-in functions only; a file is one row throughout and nothing
is shuffled but the counts of licence words.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corbel.llm.common import quoted

#: A word, once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The two letters outside ASCII whose lower case holds an ASCII letter, and one that stands for them.
_FOLDED, _PLAIN = ("K", "İ"), "é"

#: Words that may lie between a notice's words beyond its own, on either side.
SLACK = 8
#: Rare words of a notice that are looked up.
RARE = 2

#: Phrases whose places are counted, and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Label, notice, and the phrase in it that must stand word for word.
NOTICES = [
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("artistic", "licensed under the artistic license", "artistic license"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"
     " are permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files", "permission is hereby granted free of charge"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("public-domain", "released into the public domain", "into the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("warranty", "the software is provided as is without warranty of any kind",
     "without warranty of any kind"),
]


class Notice(NamedTuple):
    label: str
    words: list[str]
    key: list[str]
    at: int  # the key phrase's place in the notice
    base: bool

    @classmethod
    def of(cls, label: str, notice: str, phrase: str, base: bool = False) -> Notice:
        words, key = notice.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return cls(label, words, key, at, base)


def notices(base: dict[str, str] = BASE, more=NOTICES) -> list[Notice]:
    return [
        *(Notice.of(label, phrase, phrase, True) for phrase, label in base.items()),
        *(Notice.of(*each) for each in more),
    ]


def _texts(values) -> Column:
    return F.array(*map(F.lit, values))


def words(text: Column) -> Column:
    """A text's words; null has none."""
    plain = F.coalesce(text, F.lit(""))
    for letter in _FOLDED:
        plain = F.replace(plain, F.lit(letter), F.lit(_PLAIN))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def document_frequencies(df: DataFrame, vocabulary: list[str], text: str) -> dict[str, int]:
    """In how many documents each word occurs: one count for each word of the notices."""
    held = F.array_intersect(words(quoted(text)), _texts(vocabulary))
    counts = df.select(F.explode(held).alias("word")).groupBy("word").count()
    return {row["word"]: row["count"] for row in counts.collect()}


def scan(df: DataFrame, text: str = "text", known: list[Notice] | None = None) -> DataFrame:
    """All columns of ``df`` with the licences that each row's text holds.

    Adds ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word``
    (the smallest and largest place, null without any), ``base_labels`` and ``labels`` (of
    base phrases, of all notices: distinct, in order, joined by commas), ``score`` (the
    greatest share of a notice's words found at a place; a base phrase has all of its) and
    ``places`` (label, first word of the key phrase, words of the notice found there). Columns
    named like these are replaced, all others come back as they are. A null or empty text
    has no words and no label; repeated rows are scanned alike; an empty table gives no row.
    """
    known = notices() if known is None else known
    vocabulary = sorted({x for notice in known for x in notice.key})
    frequency = document_frequencies(df, vocabulary, text)
    rarest = sorted(vocabulary, key=lambda x: (frequency.get(x, 0), x))

    def described(number: int, notice: Notice) -> Column:
        # The index: a notice's rare words and where they stand from its key phrase on.
        rare = sorted({*notice.key}, key=rarest.index)[:RARE]
        return F.struct(
            F.lit(number).alias("number"),
            _texts(notice.key).alias("key"),
            _texts(rare).alias("rare"),
            F.array(*[F.lit(notice.key.index(x)) for x in rare]).alias("from_key"),
        )

    index = F.array(*[described(i, x) for i, x in enumerate(known)])
    spread = F.array(
        *[
            F.struct(
                F.lit(x.label).alias("label"),
                F.lit(x.base).alias("base"),
                F.lit(x.at).alias("at"),
                F.lit(len(x.words)).alias("size"),
                _texts(dict.fromkeys(x.words)).alias("words"),
            )
            for x in known
        ]
    )

    # No name of the caller's can clash with these.
    carried = [f"c{i}" for i in range(len(df.columns))]
    given = df.columns.index(text)
    rows = df.toDF(*carried).select(*carried, words(F.col(carried[given])).alias("words"))
    held = F.array_intersect(_texts(rarest), F.array_intersect("words", _texts(vocabulary)))
    rows = rows.select(*carried, "words", held.alias("held"))
    # Notices whose key words the file all holds, and of these the words to look up.
    likely = F.filter(index, lambda x: F.size(F.array_except(x["key"], "held")) == 0)
    rows = rows.select(
        *carried, "words", F.when(F.size("held") > 1, likely).alias("likely")
    ).withColumn("rare", F.array_distinct(F.flatten(F.transform("likely", lambda x: x["rare"]))))
    numbered = F.transform("words", lambda x, i: F.struct(i.alias("at"), x.alias("word")))
    looked_up = F.filter(numbered, lambda x: F.array_contains("rare", x["word"]))
    rows = rows.withColumn("hits", F.when(F.size("rare") > 0, looked_up)).drop("rare")
    rows = rows.withColumn("found", F.flatten(F.transform("likely", _agreed)))
    rows = rows.withColumn(
        "found", F.transform("found", lambda x: _measured(x, F.get(spread, x["number"])))
    )
    rows = rows.withColumn(
        "found",
        F.coalesce(
            F.array_sort(F.filter("found", lambda x: 2 * x["n_found"] >= x["n_notice"])), F.array()
        ),
    )
    base = F.transform(F.filter("found", lambda x: x["base"]), lambda x: x["at"])
    rows = rows.withColumn("base", base)

    def labels(places) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))))

    shares = F.transform("found", lambda x: x["n_found"] / x["n_notice"])
    made = {
        "n_words": F.size("words").cast("bigint"),
        "n_base": F.size("base").cast("bigint"),
        "first_word": F.array_min("base").cast("bigint"),
        "last_word": F.array_max("base").cast("bigint"),
        "base_labels": labels(F.filter("found", lambda x: x["base"])),
        "labels": labels("found"),
        "score": F.coalesce(F.array_max(shares), F.lit(0.0)),
        "places": F.transform("found", lambda x: F.struct(
            x["label"].alias("label"), x["at"].cast("bigint").alias("at"), x["n_found"].alias("n_found")
        )),
    }
    return rows.select(
        *[
            F.col(x).alias(name)
            for x, name in zip(carried, df.columns)
            if name.lower() not in made
        ],
        *[value.alias(name) for name, value in made.items()],
    )


def _agreed(notice: Column) -> Column:
    """Where the rare words' postings agree and the key phrase stands: number and place."""

    def starts(i: int) -> Column:
        own = F.filter("hits", lambda x: x["word"] == F.get(notice["rare"], F.lit(i)))
        return F.transform(own, lambda x: x["at"] - F.get(notice["from_key"], F.lit(i)))

    agreed = F.array_intersect(starts(0), starts(1))
    size = F.size(notice["key"])
    stands = F.filter(
        agreed, lambda at: (at >= 0) & (F.slice("words", at + 1, size) == notice["key"])
    )
    return F.transform(
        stands, lambda at: F.struct(notice["number"].alias("number"), at.alias("at"))
    )


def _measured(place: Column, notice: Column) -> Column:
    """A place with as many of the notice's words as stand around it."""
    first = F.greatest(place["at"] - notice["at"] - SLACK, F.lit(0))
    last = place["at"] - notice["at"] + notice["size"] + SLACK
    around = F.slice("words", first + 1, last - first)
    return F.struct(
        notice["label"].alias("label"),
        place["at"].alias("at"),
        F.size(F.array_intersect(notice["words"], around)).alias("n_found"),
        F.size(notice["words"]).alias("n_notice"),
        notice["base"].alias("base"),
    )


def oracle_sql(known: list[Notice] | None = None) -> str:
    """DuckDB SQL for the same columns, place by place and without an index."""

    def texts(values) -> str:
        return "[" + ", ".join(f"'{x}'" for x in values) + "]"

    rows = ",\n".join(
        f"('{x.label}', {texts(x.key)}, {texts(dict.fromkeys(x.words))}, {x.at}, {len(x.words)}, {x.base})"
        for x in (notices() if known is None else known)
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH notices(label, key, notice, key_at, notice_size, base) AS (VALUES
{rows}
), cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), '{upper}', '{lower}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), each AS (SELECT row_number() OVER () AS r, * FROM cut
), keys AS (
  SELECT r, doc_id, words, n.*, unnest(range(len(words) - len(key) + 1)) AS p
  FROM each JOIN notices AS n ON list_has_all(words, key)
), places AS (
  SELECT r, label, base, p,
         len(list_intersect(notice, words[greatest(p - key_at - {SLACK}, 0) + 1 : p - key_at + notice_size + {SLACK}])) AS n_found,
         len(notice) AS n_notice
  FROM keys WHERE words[p + 1 : p + len(key)] = key
), found AS (SELECT * FROM places WHERE 2 * n_found >= n_notice
), summed AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(p) FILTER (base) AS first_word,
         max(p) FILTER (base) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(n_found / n_notice) AS score
  FROM found GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM each LEFT JOIN summed USING (r)"""
