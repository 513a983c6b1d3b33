"""Spelling groups against a plain version that makes every word one letter away."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corbel.llm import spelling
from corbel.llm.queries import op13_spelling_groups

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def around(word, letters):
    yield from (word[:i] + word[i + 1 :] for i in range(len(word)))
    yield from (word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters)
    yield from (word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters)


def near(counts):
    letters = {x for word in counts for x in word}
    return {word: {x for x in around(word, letters) if x in counts and x != word} for word in counts}


def grouped(rows):
    counts = counted(rows)
    found = near(counts)
    forms = {}
    for word, others in found.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 10 * counts[word]:
            forms[word] = best
    result = set()
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        result.add((word, form, root, n, len(found[word]), counts.get(form)))
    return result


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    frame = op13_spelling_groups(spark, SF_DIR)
    assert frame.columns == COLUMNS
    got = [tuple(x) for x in frame.collect()]
    want = grouped(docs)
    assert len(got) == len(want) and set(got) == want
    assert any(x[1] for x in got)


def test_chains_ties_nulls_and_repeats(spark):
    """Chains of forms end at one root; of equally frequent spellings the first is the form."""
    words = {"spelling": 2, "spellings": 30, "spellingss": 400, "spallings": 30, "aaaaaaaa": 40,
             "aaaaaaa": 3, "bbbbbbbA": 5, "Ünlüüüü": 2, "ünlüüüü": 2, "kleinst×": 2}
    text = " ".join(word for word, n in words.items() for _ in range(n))
    rows = [(None, text), (None, text), (3, None), (4, ""), (5, "one 1234567 zwei7zwei")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(x) for x in spelling.spelling_groups(made).collect()}
    assert got == grouped(rows)


def test_other_columns_play_no_part(spark):
    """Columns may be named like any of the operator's own."""
    names = ["id", "run", "h", "word", "n", "bin", "near", "root", "form"]
    schema = "doc_id long, text string, " + ", ".join(f"`{x}` string" for x in names)
    rows = [(1, "letters " * 30 + "lettters lettters", *names)]
    got = {tuple(x) for x in spelling.spelling_groups(spark.createDataFrame(rows, schema)).collect()}
    assert got == grouped([x[:2] for x in rows])


def test_empty(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], "doc_id int, text string")).collect() == []
    made = spark.createDataFrame([(1, None), (2, "short words only")], "doc_id int, text string")
    assert spelling.spelling_groups(made).collect() == []


def test_crowded_halves_and_small_bins(spark):
    """Halves beyond a block's bound are searched block by block, to the same pairs."""
    tails = [x + y + z for x in "abcdef" for y in "abcd" for z in "abé"]
    words = [("commo" + x, 1) for x in tails] + [("commo" + x + "ns", 2) for x in tails]
    words += [(x + "tionen", 3) for x in tails] + [("longword" * 400 + x, 1) for x in "abc"]
    made = spark.createDataFrame(words, "word string, n long")
    want = {(a, b) for a, found in near(dict(words[:-3])).items() for b in found}
    long = [x for x, _ in words[-3:]]
    want |= {(a, b) for a in long for b in long if a != b}
    for bin_letters, block_words in ((1 << 20, 1 << 16), (500, 1 << 16), (300, 7)):
        got = [(x.word, x.near) for x in spelling.near_words(made, bin_letters, block_words).collect()]
        assert len(got) == len(want) and set(got) == want


WORDS = st.lists(st.text("ab", min_size=1, max_size=7), unique=True, max_size=30)


@settings(max_examples=150, deadline=None)
@given(WORDS, WORDS, st.integers(0, 4), st.integers(0, 3))
def test_one_error(held, asking, fixed, backwards):
    """The search finds exactly the held words with one letter replaced or left out before the fixed ones."""
    arrays = [[np.array([*map(ord, x)], np.int64) for x in words] for words in (held, asking)]
    asking_fixed = np.array([min(fixed, len(x)) for x in asking], np.int64)
    if not held or not asking:
        return
    at, number = spelling.one_error(arrays[0], arrays[1], asking_fixed)
    want = set()
    for i, word in enumerate(asking):
        free = len(word) - asking_fixed[i]
        made = {word[:k] + x + word[k + 1 :] for k in range(free) for x in ("", "a", "b")} - {word}
        want |= {(i, held.index(x)) for x in made if x in held}
    assert len(at) == len(want) and set(zip(at.tolist(), number.tolist())) == want
