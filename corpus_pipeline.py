"""A training corpus from raw documents: five stages, each a whole frame to a whole frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corbel.llm import jaccard, outliers, toxicity
from corbel.llm.common import read, settle
from corbel.llm.queries import (
    GROUPS,
    mix_documents,
    pack_documents,
    packed_digest,
    toxicity_model,
)


#: Columns that the stages work on.
USED = ("doc_id", "text", "lang", "source")


def closed(docs: DataFrame) -> DataFrame:
    """The columns that stages use, and all others in one that no stage's own can clash with."""
    others = [F.col(f"`{x}`").alias(f"c{i}") for i, x in enumerate(_others(docs))]
    return docs.select(*USED, F.struct(F.lit(0).alias("c"), *others).alias("carried"))


def opened(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of :func:`closed` with the columns of ``docs`` again."""
    place = {x: f"carried.c{i}" for i, x in enumerate(_others(docs))}
    return rows.select(*[F.col(place.get(x, x)).alias(x) for x in docs.columns])


def _others(docs: DataFrame) -> list[str]:
    return [x for x in docs.columns if x not in USED]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    Each row is judged by its text alone, repeated rows alike; a null text as an empty one.
    """
    model = toxicity_model(spark, docs, sf_dir)
    return opened(toxicity.classify(closed(docs), model).where("predicted = 0"), docs)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and lie within their source's cloud.

    Repeated rows count each; null languages and sources are groups of their own; a
    null or empty text has no words and fails the rules.
    """
    stats = outliers.statistics(closed(docs))
    narrow = settle(stats.select(*GROUPS, *outliers.STATISTICS), "statistics")
    judged = outliers.judge(stats, outliers.estimate(narrow, GROUPS), GROUPS)
    return opened(judged.where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near copies, and every row in none, whatever their ids."""
    return jaccard.one_of_each(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three fifths of the words, mixed to target weights; each document once at most.

    Documents without words are not selected; the last one of a source may be cut.
    """
    return opened(mix_documents(closed(docs), epochs=1), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, in windows of 2048 tokens; every row is packed on its own."""
    return packed_digest(pack_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_outliers),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_windows),
]

#: Trained models, token ids and iterated estimates are beyond SQL; ``tests/llm`` holds what each
#: stage of run() keeps against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
