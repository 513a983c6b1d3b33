"""Token alignment against a plain version that cuts each text by itself."""

from __future__ import annotations

import functools
import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corbel.llm import alignment
from corbel.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, op11_token_alignment
from corbel.llm.tokens import vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
A, B = vocabulary_path(BYTE_VOCABULARY), vocabulary_path(PIECE_VOCABULARY)
ODD = [
    None, "", " ", "a", "x▁y", "\0", "日本語 テスト", "=" * 3000 + "a", "é́", "<|endoftext|> a",
    "\n\n\n  a  b ", "🙂🙂", "a", "aaaaaaaaaaaaaaaa" * 200, " leading", "ǅ", "\x85 ",
    "The rain in Spain. " * 40, "The rain in Spain. " * 40,
]


@functools.cache
def both_libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    bytewise = Tokenizer.from_file(A)
    bytewise.encode_special_tokens = True
    return bytewise, sentencepiece.SentencePieceProcessor(model_file=B)


@functools.cache
def units():
    return [side.units.to_pylist() for side in (alignment.byte_side(A), alignment.piece_side(B))]


@pytest.fixture(scope="module")
def libraries():
    return both_libraries()


def plain(texts, libraries):
    """Counts, digest and sums of each text, one text and one group at a time."""
    bytewise, pieces = libraries
    found = []
    for text in texts:
        ids = ([], [])
        if text:
            ids = (bytewise.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text))
        tokens = [[unit[i] for i in x] for unit, x in zip(units(), ids)]
        if not text or any(b"".join(x) != (" " + text).encode() for x in tokens):
            found.append((0, 0, 0, 0, "", Counter()))
            continue
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in tokens]
        groups, links, done = [], Counter(), [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            upto = [end.index(cut, first) + 1 for end, first in zip(ends, done)]
            own = [x[first:last] for x, first, last in zip(ids, done, upto)]
            groups.append("|".join(",".join(map(str, x)) for x in own))
            links.update((x, y) for x in own[0] for y in own[1])
            done = upto
        line = ";".join(groups)
        digest = hashlib.sha256(line.encode()).hexdigest()
        found.append((len(ids[0]), len(ids[1]), len(groups), links.total(), digest, links))
    documents = Counter(pair for *_, links in found for pair in links)
    top = Counter()
    for (a, _), n in documents.items():
        top[a] = max(top[a], n)
    return [
        (
            *counts,
            sum(n for x, n in links.items() if documents[x] == top[x[0]]),
            sum(n * documents[x] for x, n in links.items()),
        )
        for *counts, links in found
    ]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def rows(frame, *keys):
    return [tuple(row[x] for x in (*keys, *FIELDS)) for row in frame.collect()]


def test_odd_texts(spark, libraries):
    made = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "doc_id long, text string")
    got = sorted(rows(alignment.align(made.repartition(3), A, B), "doc_id"))
    assert got == [(i, *x) for i, x in enumerate(plain(ODD, libraries))]


def test_query(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = plain([x.text for x in docs], libraries)
    got = rows(op11_token_alignment(spark, SF_DIR), "doc_id")
    assert sorted(got) == sorted((d.doc_id, *x) for d, x in zip(docs, want))


def test_slices_share_counts(spark, libraries, monkeypatch):
    """Pairs are counted over slices, also where a slice is one text longer than its bound."""
    monkeypatch.setattr(alignment, "SLICE", 64)
    texts = ["rain in Spain", "rain, rain and rain" * 20, "Spain", None] * 3
    made = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    got = sorted(rows(alignment.align(made.coalesce(1), A, B), "doc_id"))
    assert got == [(i, *x) for i, x in enumerate(plain(texts, libraries))]


def test_clashing_and_repeated_rows(spark, libraries):
    """The caller's columns come back, those named like results are replaced, repeats stay."""
    names = ["slice", "asked", "rows", "carried", "pair", "at", "n", "best", "c0", "row", "N_A"]
    schema = "doc_id long, text string, " + ", ".join(f"{x} string" for x in names)
    row = (None, "Spain", *names)
    got = alignment.align(spark.createDataFrame([row, row, (1, None, *[None] * 11)], schema), A, B)
    assert got.columns == ["doc_id", *names[:-1], *FIELDS[:5], *FIELDS[5:]]
    want = plain(["Spain", "Spain", None], libraries)
    order = lambda x: str(x)
    assert sorted(rows(got, "doc_id", *names[:-1]), key=order) == sorted(
        [(None, *names[:-1], *want[0])] * 2 + [(1, *[None] * 10, *want[2])], key=order
    )


def test_empty(spark):
    empty = spark.createDataFrame([], "text string")
    assert alignment.align(empty, A, B).collect() == []


def test_ids_are_the_librarys_on_all_characters(libraries):
    """The ranks give the ids of the vocabulary's own library, special strings included."""
    side = alignment.byte_side(A)
    points = [x for x in range(0x32000) if not 0xD800 <= x < 0xE000]
    texts = ["".join(f"a{chr(x)}b {chr(x)}{chr(x)} 1{chr(x)}\n" for x in points[i : i + 64])
             for i in range(0, len(points), 64)] + ["<|endoftext|>", "a<|endoftext|>b"]
    ids, counts = side.ids(texts)
    want = [x.ids for x in libraries[0].encode_batch([" " + x for x in texts], add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=30) | st.sampled_from([None, "aaaa" * 9, "  "]), max_size=6))
def test_any_texts(texts):
    """Sums over one slice by kinds of groups equal those over all links."""
    want = plain(texts, both_libraries())
    aligned = alignment.Aligned(texts, alignment.byte_side(A), alignment.piece_side(B))
    tally, made = alignment.measured(aligned, len(texts))
    assert list(zip(*(x.to_pylist() for x in made))) == [x[:5] for x in want]
    n = tally.documents()
    a = tally.pairs >> 32
    top = {i: n[a == i].max() for i in set(a.tolist())}
    best = np.array([n[i] == top[x] for i, x in enumerate(a.tolist())], np.int64)
    sums = alignment._sums(tally.packed(), len(aligned.docs), [best, n])
    held = [x[5:] for x in want if x[0]]
    assert list(zip(*(x.tolist() for x in sums))) == held


def test_crowded_groups(monkeypatch):
    """Equal ids of a crowded group are taken together with the same result."""
    text = ["=" * 500 + "a", "日本語" * 30]
    sides = alignment.byte_side(A), alignment.piece_side(B)
    wide = alignment.Tally(x := alignment.Aligned(text, *sides), x.written()[0])
    monkeypatch.setattr(alignment, "CROWDED", 1)
    monkeypatch.setattr(alignment, "LAID_OUT", 2)
    close = alignment.Tally(x, x.written()[0])
    assert wide.packed() == close.packed()
    assert wide.documents().tolist() == close.documents().tolist()
