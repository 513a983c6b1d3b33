"""Near duplicates of texts and vectors against all pairs compared one by one."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corbel.llm import jaccard, queries, vectors
from corbel.llm.components import components
from corbel.llm.shingles import U64

SF_DIR = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components_of(keys, links):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {k: find(k) for k in keys}


def groups_of(texts):
    """Component of each key, by comparing each pair that shares a shingle."""
    sets = {k: shingles(t) for k, t in texts.items()}
    holders, pairs = {}, set()
    for key, own in sets.items():
        for shingle in own:
            for other in holders.setdefault(shingle, []):
                pairs.add((other, key))
            holders[shingle].append(key)
    links = [
        (a, b)
        for a, b in pairs
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    named = components_of(texts, links)
    return {k: (len(sets[k]), named[k]) for k in texts}


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.read(spark, SF_DIR, "documents").collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id)
             for r in queries.op8_jaccard_groups(spark, SF_DIR).collect()}
    wanted = groups_of(texts)
    assert found == wanted
    assert sum(k != c for k, (_, c) in wanted.items()) > 50


def edited(words, changes, chance):
    words = list(words)
    for _ in range(changes):
        at = chance.randrange(len(words))
        words[at : at + chance.randrange(2)] = [f"new{chance.random()}"]
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_edited_copies_and_shared_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_LEAST", 3)
    chance = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = {}
    for base in range(25):
        words = [f"w{base}_{i}" for i in range(chance.choice([1, 3, 5, 6, 8, 12, 40, 200]))]
        if base % 2:
            words += passage
        for _ in range(chance.randrange(1, 9)):
            texts[len(texts)] = edited(words, chance.randrange(1 + len(words) // 18), chance)
    for text in ("", None, " \n", "A b", "a B", "a  b", "x" * 5000):
        texts[len(texts)] = text
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    df = df.withColumn("node", F.lit("x")).withColumn("n_shingles", F.lit(3))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.group_documents(df).collect()}
    assert found == groups_of(texts)


def test_no_pair_is_missed():
    chance = random.Random(5)
    tried = 0
    for trial in range(1500):
        a = [chance.getrandbits(63) for _ in range(chance.choice([1, 2, 3, 4, 5, 7, 8, 15, 16, 33, 90]))]
        b = list(a)
        for _ in range(chance.randrange(len(a) // 3 + 1)):
            at = chance.randrange(len(b))
            b[at : at + chance.randrange(2)] = [chance.getrandbits(63)] * chance.randrange(2)
            b = b or [1]
        both, either = len(set(a) & set(b)), len(set(a) | set(b))
        if 100 * both < 75 * either:
            continue
        tried += 1
        common = np.sort(np.array(a[: len(a) // 2] if trial % 2 else [], U64))
        elements = np.concatenate([np.array(sorted(set(x)), U64) for x in (a, b)])
        keys, owners = jaccard.set_keys(
            elements, np.array([0, len(set(a)), len(set(a)) + len(set(b))]), common
        )
        assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())
    assert tried > 500


def test_sketches_rule_out_no_pair_that_links():
    chance = np.random.default_rng(8)
    for size in (1, 5, 7, 8, 30, 63, 64, 200, 511, 512, 2000):
        base = chance.integers(0, 2**63, size).astype(U64)
        sets = [np.unique(base)]
        for _ in range(12):
            own = base[chance.random(size) > chance.random() * 0.3]
            sets.append(np.unique(np.append(own, chance.integers(0, 2**63, size // 7).astype(U64))))
        sizes = np.array([len(x) for x in sets])
        table, apart = jaccard.possible(sizes, [jaccard.sketch(x, len(x)) for x in sets])
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if both and 100 * both >= 75 * (len(a) + len(b) - both):
                    assert table[i, j] and table[j, i]
        links = list(zip(*jaccard.tree(table, apart)))
        assert all(table[i, j] for i, j in links)
        named = components_of(range(len(sets)), zip(*np.nonzero(table)))
        assert named == components_of(range(len(sets)), links)


def test_crowds_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    words = [f"w{i}" for i in range(80)]
    chance = random.Random(9)
    rows = [(i % 12, edited(words, 2, chance)) for i in range(24)]
    rows += [(None, rows[0][1]), (None, "only here is a text of its own"), (99, "another one " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = jaccard.group_documents(df).collect()
    assert len(found) == len(rows)
    by_text = {k: c for k, (_, c) in groups_of(dict(enumerate(t for _, t in rows))).items()}
    names = {}
    for number, (key, _) in enumerate(rows):
        if key is not None:
            group = by_text[number]
            names[group] = min(names.get(group, key), key)
    wanted = [(k, len(shingles(t)), names.get(by_text[i])) for i, (k, t) in enumerate(rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_empty_tables(spark):
    assert jaccard.group_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vectors.link_vectors(none).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    chance = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)]
    links += [(chance.randrange(400, 500), chance.randrange(400, 500)) for _ in range(70)] + [(7, 7)]
    named = components_of({x for p in links for x in p}, links)
    chance.shuffle(links)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {
        k: v for k, v in named.items() if any(k in p and p[0] != p[1] for p in links)
    }


def all_pairs(rows, threshold=0.9):
    good = [
        i for i, (_, v) in enumerate(rows)
        if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    counts, links = [0] * len(rows), []
    for length in {len(rows[i][1]) for i in good}:
        own = [i for i in good if len(rows[i][1]) == length]
        units = np.array([rows[i][1] for i in own], float)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        close = units @ units.T >= threshold
        for x, y in zip(*np.nonzero(np.triu(close, 1))):
            a, b = own[x], own[y]
            links.append((a, b))
            counts[a] += 1
            counts[b] += 1
    return counts, links


@pytest.mark.parametrize("block", [vectors.BLOCK, 16])
def test_vector_query_recall(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "CELL", 20)
    rows = [
        (r.vec_id, r.embedding) for r in queries.read(spark, SF_DIR, "embeddings").collect()
    ]
    counts, links = all_pairs(rows)
    named = components_of([k for k, _ in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    found = {r.vec_id: r for r in queries.op5_vector_groups(spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    total = sum(found[k].n_links for k, _ in rows)
    for n, (key, _) in enumerate(rows):
        assert found[key].n_links <= counts[n]
        assert found[key].kept == (key == found[key].component_id)
    assert total >= 0.99 * sum(counts)
    alike = sum(found[k].component_id == c for k, c in named.items())
    assert alike >= 0.99 * len(rows)


def test_vectors_in_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    monkeypatch.setattr(vectors, "CELL", 10)
    chance = np.random.default_rng(1)
    base = chance.normal(size=(4, 24))
    near = [(base[i % 4] + 0.12 * chance.normal(size=24)).tolist() for i in range(160)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(near + odd + near[:3]))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumn("cell", F.lit(0)).withColumn("unit", F.lit("x"))
    counts, links = all_pairs(rows)
    named = components_of(range(len(rows)), links)
    found = {r.vec_id: r for r in vectors.link_vectors(df).collect()}
    assert sum(found[k].n_links for k in found) >= 0.97 * sum(counts)
    assert all(found[k].n_links <= counts[k] for k in found)
    assert {k: r.component_id for k, r in found.items()} == named


def test_a_pair_is_looked_at_in_one_of_its_groups():
    """Of all groups that two members share, exactly the one of the smallest name has the pair."""
    rng = np.random.default_rng(4)
    groups = {int(key): rng.choice(40, rng.integers(2, 30), replace=False) for key in rng.integers(-9, 9**9, 60)}
    keys = {n: np.sort([key for key, own in groups.items() if n in own]).astype(np.int64) for n in range(40)}
    seen = {}
    for key, own in groups.items():
        before = jaccard.met_before(key, [keys[n] for n in own])
        for i, j in zip(*np.nonzero(np.triu(~before, 1))):
            pair = tuple(sorted((int(own[i]), int(own[j]))))
            seen[pair] = seen.get(pair, 0) + 1
    wanted = {
        (a, b) for own in groups.values() for a in own.tolist() for b in own.tolist() if a < b
    }
    assert seen == dict.fromkeys(wanted, 1)


def test_one_row_of_each_group_stays(spark):
    """Rows are told apart, not ids: equal ids on different texts lose nothing, repeats go."""
    a, b = "one two three four five six seven eight nine ten eleven twelve", "nothing like any other text here"
    near = a + " thirteen"
    rows = [
        (3, a, "x"), (3, a, "y"), (7, near, "x"), (7, b, "x"), (None, b, "z"), (None, "", "x"),
        (1, None, "x"), (1, None, "x"), (9, "?", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    found = sorted((tuple(r) for r in kept.collect()), key=repr)
    by_text = [(r[0], r[1]) for r in found]
    assert (3, a) in by_text and (7, b) in by_text and len(found) == 6
    assert by_text.count((1, None)) == 2 and (None, "") in by_text and (9, "?") in by_text
    assert jaccard.one_of_each(df.limit(0)).collect() == []


def planted(rank, count, seed, noise=0.0):
    """Unit vectors of some rank in 64 dimensions, half of them near the other half if ``noise``."""
    rng = np.random.default_rng(seed)
    found = rng.normal(size=(count, rank)) @ np.linalg.qr(rng.normal(size=(64, rank)))[0].T
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    if noise:
        half = count // 2
        found[half:] = found[:half] + rng.normal(size=(half, 64)) * noise
        found /= np.linalg.norm(found, axis=1, keepdims=True)
    return found


@pytest.mark.parametrize("rank, noise, wanted", [(3, 0, 1.0), (5, 0, 0.99), (64, 0.05, 0.99)])
def test_visits_find_planted_links(rank, noise, wanted):
    """With the shipped constants and 24 cells, nearly every link has an end that visits the other's cell."""
    units = planted(rank, 12_000, 1, noise)
    centres = vectors.centroids(units, 24)
    recalls = []
    for reach in (vectors.reaches(units, centres, 0.9), np.full(24, vectors.farthest(0.9))):
        home, close = vectors.visits(units, centres, reach)
        close[np.arange(len(units)), home] = True
        total = found = 0
        for first in range(0, len(units), 2000):
            some = slice(first, first + 2000)
            linked = units[some] @ units.T >= 0.9
            total += int(linked.sum())
            found += int((linked & (close[some][:, home] | close[:, home[some]].T)).sum())
        assert total > (1.8 if noise else 10) * len(units)
        recalls.append(found / total)
    assert recalls[0] >= wanted and recalls[1] == 1


@pytest.mark.parametrize("exact", [False, True])
def test_planted_links_end_to_end(spark, monkeypatch, exact):
    monkeypatch.setattr(vectors, "CELL", 100)
    units = planted(64, 2400, 7, 0.05)
    rows = [(n, x.tolist()) for n, x in enumerate(units)] + [(5000, None), (5001, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r for r in vectors.link_vectors(df, exact=exact).collect()}
    links = units @ units.T >= 0.9
    counts = links.sum(axis=1) - 1
    total = sum(found[n].n_links for n in range(len(units)))
    assert counts.sum() >= 2000 and all(found[n].n_links <= counts[n] for n in range(len(units)))
    assert total >= 0.99 * counts.sum() and (not exact or total == counts.sum())
    assert found[5000].n_links == found[5001].n_links == 0 and found[5001].kept
