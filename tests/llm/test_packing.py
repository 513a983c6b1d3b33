"""Packed windows: every id once, no gaps, the mixture held and deficits carried."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corbel.llm import packing, queries
from corbel.llm.tokens import tokenizer, vocabulary_path
from tests.llm.test_tokens import digest

PATH = vocabulary_path(queries.WORD_VOCABULARY)
SF_DIR = "/root/testdata/sf0.001"


def ids_of(text):
    return tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def whole(rows):
    """Sequences are gapless and full, but the last."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == packing.WINDOW or number == len(sequences) - 1
    return len(sequences)


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.read(spark, SF_DIR, "documents").collect()}
    rows = queries.op4_mixture_packing(spark, SF_DIR).collect()
    total = sum(row.length for row in rows)
    assert whole(rows) == -(-total // packing.WINDOW)
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids, at = ids_of(texts[doc_id]), 0
        for row in sorted(own, key=lambda r: r.start):
            assert row.start == at and row.doc_tokens == len(ids)
            at += row.length
            assert row.ids_crc32 == digest(ids[row.start : at])
        assert at == len(ids)


def test_shares_hold_in_every_window(spark):
    df = queries.read(spark, SF_DIR, "documents").select("doc_id", "source", "text")
    weights = {"src1": 5, "src2": 2.5}
    rows = packing.pack(df, PATH, F.col("source"), weights).collect()
    whole(rows)
    used, left = defaultdict(Counter), Counter()
    for row in rows:
        used[row.sequence_id][row.source] += row.length
        left[row.source] += row.length
    names = sorted(left)
    served = Counter()
    for number in range(len(used)):
        active = [n for n in names if left[n] - served[n] > used[number][n]]
        if len(active) == len(names):
            scale = sum(weights.get(n, 1) for n in names)
            for n in names:
                assert abs(used[number][n] - packing.WINDOW * weights.get(n, 1) / scale) < 4
        served.update(used[number])


def test_schedule_is_monotone_and_exact():
    chance = np.random.default_rng(4)
    for _ in range(30):
        count = int(chance.integers(1, 9))
        totals = chance.integers(1, 400, count).tolist()
        schedule = packing.Schedule(totals, chance.uniform(0.1, 9, count).tolist())
        every = np.arange(sum(totals) + 1)
        served = np.array(
            [schedule.served(every, np.full_like(every, q))[0] for q in range(count)]
        )
        assert (served.sum(axis=0) == every).all()
        assert (np.diff(served, axis=1) >= 0).all()
        assert served[:, -1].tolist() == totals


def test_odd_tables(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "a"), (3, "word " * 9000, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").select(
        "*", F.lit(7).alias("length"), F.lit(8).alias("queue"), F.lit(9).alias("Part")
    )
    packed = packing.pack(df, PATH, F.col("source"))
    found = packed.collect()
    assert whole(found) == 5
    assert Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0) == {
        (1, 1): 2, (None, 1): 1, (3, 9001): 1,
    }
    joined = packing.sequences(packed).orderBy("sequence_id").collect()
    assert [r.n_tokens for r in joined] == [2048] * 4 + [9004 - 4 * 2048]
    assert all(len(r.ids) == 4 * r.n_tokens for r in joined)
    assert packing.pack(df.where("false"), PATH, F.col("source")).count() == 0
    with pytest.raises(ValueError):
        packing.Schedule([3], [0])


@pytest.mark.parametrize("weights", [None, {"s3": 4, "s11": 2}])
def test_more_sources_than_queues(spark, monkeypatch, weights):
    """Beyond the queues that the driver lists, sources follow one another; nothing is lost."""
    monkeypatch.setattr(packing, "QUEUES", 5)
    monkeypatch.setattr(packing, "WEIGHTED_QUEUES", 5)
    monkeypatch.setattr(packing, "GROUPS", 3)
    texts = [(i, f"s{i % 23}" if i % 24 else None, "word " * (i * 37 % 400)) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id bigint, source string, text string").repartition(4)
    found = packing.pack(df, PATH, F.col("source"), weights).collect()
    assert whole(found) == -(-sum(len(ids_of(t)) for *_, t in texts) // packing.WINDOW)
    pieces = defaultdict(list)
    for row in found:
        pieces[row.doc_id].append(row)
    for doc_id, _, text in texts:
        ids, at = ids_of(text), 0
        for row in sorted(pieces[doc_id], key=lambda r: r.start):
            assert row.start == at
            at += row.length
            got = np.frombuffer(row.ids, "<u4").tolist()
            assert got == ids[row.start : at]
        assert at == len(ids)
    if weights:
        # A named source keeps a queue of its own, however small.
        first = Counter()
        for row in found:
            if row.sequence_id == 0:
                first[row.source] += row.length
        assert abs(first["s3"] - 2 * first["s11"]) < 8


def test_no_name_of_the_callers_clashes(spark):
    names = ["queue", "part", "place", "token_ids", "carried", "number", "queue_base", "c0", "c1"]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{x} string" for x in names)
    df = spark.createDataFrame([(1, "a b", "s", *names), (None, None, None, *[None] * 9)], schema)
    packed = packing.pack(df, PATH, F.col("source"))
    made = ["doc_tokens", "start", "length", "ids", "sequence_id", "offset"]
    assert packed.columns == ["doc_id", "source", *names, *made]
    found = {row.doc_id: row for row in packed.collect()}
    assert [found[1][x] for x in names] == names and [found[None][x] for x in names] == [None] * 9


def test_rounds_played_one_by_one():
    """Serving windows in turn, with what each queue is owed carried on, gives the same pieces."""
    totals, weights, window = [700, 90, 1500, 333], [5, 1, 9, 2], 64
    schedule = packing.Schedule(totals, weights)
    every = np.arange(0, sum(totals) + window, window)
    formula = np.array([schedule.served(every, np.full_like(every, q))[0] for q in range(4)])
    served = np.zeros(4)
    for number in range(1, len(every)):
        active = np.array([served[q] < totals[q] for q in range(4)])
        share = window * np.where(active, weights, 0) / max(1, np.where(active, weights, 0).sum())
        now = formula[:, number] - formula[:, number - 1]
        # Within a window a queue gets its share, less or more by the fractions owed to it.
        if (formula[:, number] < totals).all():
            assert (abs(now - share) < 3).all()
            assert (abs(formula[:, number] - number * share) < 3).all()
        served = formula[:, number]
        assert now.sum() == min(window, sum(totals) - (number - 1) * window)
