"""Licence scan against a plain version; the query has its SQL as well."""

from __future__ import annotations

import re

from corbel.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FIELDS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
UPPER = {ord(x): x.lower() for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

TEXTS = [
    None,
    "",
    "!!",
    "CC BY",
    "cc by, CC-BY; ccby cc  by",
    "All Rights\nreserved. all rights all rights reserved",
    "General Public License",
    "GNU GENERAL PUBLIC LICENSE Version 3 of the gnu general public license",
    "lİcense general public lİcense, all rights reserved by K",
    "Released under the MIT License.",
    "mit license",
    "license mit released under the",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "charge free of granted hereby is permission",
    "Licensed under CC BY-NC 4.0.",
    "words " * 5000 + "all rights reserved " + "cc by " * 3000,
    "é all rights reservedé rights reserved all",
    "dedicated to the public domain under CC0 1.0",
]


def plain(text):
    words = WORD.findall((text or "").translate(UPPER))
    base, labels, shares = [], set(), []
    for notice in licences.notices():
        size = len(notice.key)
        for at in range(len(words) - size + 1):
            if words[at : at + size] == notice.key:
                first = max(0, at - notice.at - licences.SLACK)
                last = at - notice.at + len(notice.words) + licences.SLACK
                share = len({*notice.words} & {*words[first:last]}) / len({*notice.words})
                if share >= 0.5:
                    labels.add(notice.label)
                    shares.append(share)
                    if notice.base:
                        base.append((at, notice.label))
    places = [x for x, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None),
        ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), max(shares, default=0.0),
    )


def rows(frame, *keys):
    return [tuple(row[x] for x in (*keys, *FIELDS)) for row in frame.collect()]


def test_texts(spark):
    made = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "doc_id long, text string")
    got = sorted(rows(licences.scan(made.repartition(3)), "doc_id"))
    assert got == [(i, *plain(x)) for i, x in enumerate(TEXTS)]
    assert got[3][2] == 1 and got[8][2] == 1 and got[7][6] == "gpl,gpl-3.0"


def test_which_words_are_rare_changes_no_result(spark):
    """Half of the corpus holds a notice's words, so others are the rare ones."""
    noise = [" ".join(x.key[::-1]) for x in licences.notices()] * 20 + ["cc all license"] * 50
    made = spark.createDataFrame([(x,) for x in TEXTS + noise], "text string")
    got = rows(licences.scan(made))
    assert sorted(got, key=str) == sorted((plain(x) for x in TEXTS + noise), key=str)


def test_clashing_names_repeats_and_nulls(spark):
    """Columns named like results are replaced, all others come back, repeated rows stay."""
    names = ["words", "held", "likely", "rare", "hits", "found", "base", "c0", "c1", "LABELS"]
    schema = "id long, text string, " + ", ".join(f"{x} string" for x in names)
    row = (None, "cc by", *names)
    got = licences.scan(spark.createDataFrame([row, row, (2, None, *[None] * 10)], schema))
    assert got.columns == ["id", "text", *names[:-1], *FIELDS, "places"]
    assert sorted(rows(got, "id", "text", *names[:-1]), key=str) == sorted(
        [(None, "cc by", *names[:-1], *plain("cc by"))] * 2
        + [(2, None, *[None] * 9, *plain(None))],
        key=str,
    )


def test_empty(spark):
    assert licences.scan(spark.createDataFrame([], "text string")).collect() == []


def test_places(spark):
    made = spark.createDataFrame([("so cc by, and all rights reserved",)], "text string")
    places = licences.scan(made).first()["places"]
    assert [tuple(x) for x in places] == [("cc-by", 1, 2), ("reserved", 4, 3)]


def test_plan_shuffles_counts_only(spark):
    made = spark.createDataFrame([("cc by",)], "text string")
    plan = licences.scan(made)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
