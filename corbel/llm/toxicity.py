"""Toxicity of whole texts: a linear classifier of character n-grams.

A text's features are the n-grams of 3 to 5 bytes that it has (ASCII letters in
lower case), each scaled by its naive Bayes log-count ratio: how much more
often texts labelled 1 have it than others. A logistic regression is trained on
these. It is fitted on the driver to a bounded sample of labelled rows; every
text is then scored in its own task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, importable, map_batches, quoted, settle, slices
from corbel.llm.shingles import LOWER

SIZES = (3, 4, 5)
BUCKETS = 1 << 20
#: Labelled rows that the classifier is fitted to, the first in a hashed order; a third of
#: them labelled 1 at most, so that a rare label is learned as well.
SAMPLE = 4000
#: An n-gram must be in so many sampled texts, and its log-count ratio so far from 0.
LEAST_TEXTS, LEAST_RATIO = 5, 0.25
#: N-grams of texts that a training step looks at together, which bounds the driver's memory.
STEP = 1 << 20
ROUNDS, RATE, PENALTY = 80, 0.05, 1e-3
#: N-grams are taken from so many bytes at a time, which bounds memory for long texts.
CHUNK = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Buckets of the n-grams that a text has, each once, in order."""
    data = LOWER[np.frombuffer(f" {text or ''} ".encode(), np.uint8)]
    found = []
    for first in range(0, len(data), CHUNK):
        part = data[first : first + CHUNK + SIZES[-1] - 1].astype(np.uint32)
        for size in SIZES:
            count = len(part) - size + 1
            if count <= 0:
                continue
            hashed = np.full(count, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(size):
                hashed = (hashed ^ part[i : i + count]) * np.uint32(0x01000193)
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x85EBCA6B)
            hashed ^= hashed >> np.uint32(13)
            found.append(np.unique(hashed & np.uint32(BUCKETS - 1)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class Classifier:
    """A weight per bucket and an intercept; 4 MB whatever the corpus."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        reach = self.intercept + float(self.weights[features(text)].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(reach, -500, 500)))


def fit(index: np.ndarray, sizes: np.ndarray, labels: np.ndarray, ratio: np.ndarray):
    """Weights of the features and the intercept, for texts whose features lie end to end.

    ``index`` numbers each text's features (``sizes`` of them), ``ratio`` scales them;
    labels are 0 and 1, and both occur.
    """
    total, ones, count = len(labels), int(labels.sum()), len(ratio)
    text = np.repeat(np.arange(total, dtype=np.int32), sizes)
    parts = [slice(at, at + STEP) for at in range(0, len(index), STEP)]
    # Gradient steps with running means of the gradient and of its square.
    weights, bias = np.zeros(count), np.log(ones / (total - ones))
    mean, square = np.zeros(count + 1), np.zeros(count + 1)
    for step in range(1, ROUNDS + 1):
        scaled, reach, pull = ratio * weights, np.full(total, bias), np.zeros(count)
        for part in parts:
            reach += np.bincount(text[part], weights=scaled[index[part]], minlength=total)
        error = (1 / (1 + np.exp(-np.clip(reach, -500, 500))) - labels) / total
        for part in parts:
            pull += np.bincount(index[part], weights=error[text[part]], minlength=count)
        slope = np.append(ratio * pull + PENALTY * weights / total, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return ratio * weights, float(bias)


def _constant(rate: float) -> Classifier:
    """Nothing to tell apart: every text is as likely as the labels say."""
    return Classifier(np.zeros(BUCKETS, np.float32), 500.0 if rate else -500.0)


def train(
    df: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> Classifier:
    """Fit to at most ``sample`` rows of ``labels`` (``key``, ``label``) and their texts in ``df``.

    Labels other than 0 and 1 and null keys are left out; a key labelled twice counts
    with its larger label. The sample's share of label 1 is not the labels' own, so the
    intercept is moved by the difference of their odds: scores mean the same however many
    rows are labelled. N-grams are counted in Spark; only those often enough and
    telling enough are taken from the sample's texts, and these numbers, at most four
    bytes for each of ``BUCKETS`` and row, come to the driver.
    """
    importable(df.sparkSession)
    known = settle(
        labels.where(quoted(label).isin(0, 1) & quoted(key).isNotNull())
        .groupBy(quoted(key).alias("key"))
        .agg(F.max(quoted(label)).cast("int").alias("label")),
        "labels",
    )
    marked = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    most = {1: sample // 3, 0: sample - sample // 3}

    def first(value: int) -> DataFrame:
        return known.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(most[value])

    # Bounded by ``sample``.
    chosen = F.broadcast(first(1).unionByName(first(0)))
    texts = df.select(quoted(key).alias("key"), quoted(text).alias("text")).join(chosen, "key")
    rows = settle(_with_features(texts.select("label", "text")), "labelled-features")
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    if not ones or not zeros:
        return _constant(ones / (ones + zeros) if ones + zeros else 0.0)
    bucket, ratio = _telling(rows, ones, zeros)
    index, sizes, marks = _taken(rows, bucket)
    weights, bias = fit(index, sizes, marks, ratio)
    sampled = min(marked[1], most[1]) / min(marked[0], most[0])
    made = np.zeros(BUCKETS, np.float32)
    made[bucket] = weights
    return Classifier(made, bias - float(np.log(sampled * marked[0] / marked[1])))


def _with_features(texts: DataFrame) -> DataFrame:
    """``label`` and ``features`` (buckets) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [features(x.as_py()) for x in column(batch, "text")]
            offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(x) for x in found])])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate(found).astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [column(batch, "label"), lists], names=["label", "features"]
            )

    return texts.mapInArrow(run, "label int, features array<int>")


def _telling(rows: DataFrame, ones: int, zeros: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that tell the labels apart, in order, and their log-count ratios."""
    with_one, with_any = F.col("with_one"), F.col("with_any")
    ratio = F.log((with_one + 1) / (ones + 2)) - F.log((with_any - with_one + 1) / (zeros + 2))
    table = (
        rows.select("label", F.explode("features").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("label").alias("with_one"), F.count("*").alias("with_any"))
        .select("bucket", "with_any", ratio.alias("ratio"))
        .where((with_any >= LEAST_TEXTS) & (F.abs("ratio") >= LEAST_RATIO))
        .select("bucket", "ratio")
        .toArrow()
    )
    bucket = table.column("bucket").to_numpy()
    order = np.argsort(bucket)
    return bucket[order], table.column("ratio").to_numpy()[order]


def _taken(rows: DataFrame, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``bucket`` of each row's features, their number for each row, and the labels."""
    held = rows.sparkSession.sparkContext.broadcast(bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.full(BUCKETS, -1, np.int32)
        places[held.value] = np.arange(len(held.value), dtype=np.int32)
        for batch in batches:
            found = [places[x.values.to_numpy()] for x in column(batch, "features")]
            kept = [x[x >= 0].tobytes() for x in found]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "label"), pa.array(kept, pa.binary())], names=["label", "places"]
            )

    table = rows.mapInArrow(run, "label int, places binary").toArrow()
    held.destroy()
    # In one order, so that sums are the same in every run.
    table = table.sort_by([("label", "ascending"), ("places", "ascending")]).combine_chunks()
    joined = table.column("places").combine_chunks().cast(pa.large_binary())
    sizes = pc.binary_length(joined).to_numpy() // 4
    flat = joined.buffers()[2]
    index = np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)
    return index, sizes, table.column("label").to_numpy().astype(np.int64)


def classify(df: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    Null and empty texts are scored by the blanks around a text. Rows are
    independent; columns named like the new ones are replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(classifier)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        scores = np.array([held.value.score(x.as_py()) for x in column(batch, text)])
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_batches(df, fields, compute)
