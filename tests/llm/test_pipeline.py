"""The pipeline's stages, each against a plain version of what it must keep."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corbel.llm import outliers, queries, toxicity
from tests.llm.test_duplicates import groups_of
from tests.llm.test_packing import ids_of, whole

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with repeated rows, ids on several texts, null ids and texts, and odd columns."""
    rows = queries.read(spark, SF_DIR, "documents").withColumn("key", F.lit("mine"))
    first = rows.where("doc_id < 6")
    odd = [
        first,
        first.withColumn("doc_id", F.lit(3).cast("bigint")),
        rows.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("bigint")),
        rows.where("doc_id = 10").withColumn("text", F.lit(None).cast("string")),
        rows.where("doc_id = 11").withColumn("text", F.lit("")),
    ]
    for more in odd:
        rows = rows.unionByName(more)
    return rows.withColumn("predicted", F.lit(9)).withColumn("kept", F.lit("mine"))


def counted(rows):
    return Counter(tuple(row) for row in rows)


def test_stages_one_after_another(spark, docs):
    """Every stage works on all its predecessor kept, and its rows are those of the plain version."""
    stages = [function for _, function in corpus_pipeline.STAGES]
    before = docs.collect()

    clean = stages[0](spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    model = queries.toxicity_model(spark, docs, SF_DIR)
    mild = [row for row in before if model.score(row.text) < 0.5]
    assert counted(clean.collect()) == counted(mild) and 0 < len(mild) < len(before)

    sound = stages[1](spark, clean, SF_DIR)
    stats = outliers.statistics(clean.select("doc_id", "text", *queries.GROUPS))
    judged = outliers.judge(stats, outliers.estimate(stats, queries.GROUPS), queries.GROUPS)
    by_text = {row.text: row.kept for row in judged.collect()}
    kept = [row for row in mild if by_text[row.text]]
    assert counted(sound.collect()) == counted(kept)
    for row in kept:
        assert len(WORD.findall(row.text or "")) >= 10

    single = stages[2](spark, sound, SF_DIR)
    found = single.collect()
    plain = groups_of(dict(enumerate(row.text for row in kept)))
    component = {number: group for number, (_, group) in plain.items()}
    groups = defaultdict(set)
    for number, row in enumerate(kept):
        groups[component[number]].add(tuple(row))
    assert len(found) == len(groups)
    assert all(any(tuple(row) in own for own in groups.values()) for row in found)
    left = Counter(tuple(row) for row in found)
    assert all(sum(left[x] for x in own) == 1 for own in groups.values())

    mixed = stages[3](spark, single, SF_DIR)
    assert mixed.columns == docs.columns
    taken = mixed.collect()
    whole_texts = {(row.doc_id, row.source): row.text for row in found}
    for row in taken:
        assert whole_texts[row.doc_id, row.source].startswith(row.text) and row.key == "mine"
    words = sum(len(WORD.findall(row.text)) for row in found)
    assert sum(len(WORD.findall(row.text)) for row in taken) == words * 3 // 5

    packed = stages[4](spark, mixed, SF_DIR).collect()
    total = sum(len(ids_of(row.text)) for row in taken)
    assert sum(row.length for row in packed) == total
    assert whole(packed) == -(-total // 2048)


def test_run_is_its_stages(spark):
    frame = queries.read(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF_DIR)
    names = ["doc_id", "start", "length", "doc_tokens"]
    found = corpus_pipeline.run(spark, SF_DIR)
    assert counted(found.select(*names).groupBy("doc_id").agg(F.sum("length")).collect()) == counted(
        frame.select(*names).groupBy("doc_id").agg(F.sum("length")).collect()
    )


def test_empty_table_goes_through(spark):
    frame = queries.read(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF_DIR)
    assert frame.collect() == []


def test_classifier_of_the_pipeline_is_learned_from_its_own_documents(spark, docs):
    model = queries.toxicity_model(spark, docs, SF_DIR)
    assert isinstance(model, toxicity.Classifier) and np.isfinite(model.weights).all()
