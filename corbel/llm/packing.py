"""Packing documents into token windows that each hold the target mixture of sources.

Every source is a queue of tokens. In each round - a window - a queue earns a
quantum of its weight's share of the window, serves whole tokens and carries
the fraction it could not serve as its deficit; a queue that runs dry leaves its
share to the others. What a queue has served after any number of tokens is a
formula of whole numbers (:class:`Schedule`), so the rounds need not be played
one after another: each task works out the pieces of its own documents, with
the deficits that all windows and partitions before have left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, quoted, settle, slices, with_columns
from corbel.llm.tokens import word_encoder

WINDOW = 2048
#: Queues that the driver lists; beyond them the smaller sources follow one another in one
#: queue. With weights of their own queues run dry one by one, and each time takes a table.
QUEUES, WEIGHTED_QUEUES = 4096, 256
#: Groups in which the sources of the shared queue are summed.
GROUPS = 4096
#: Weights are scaled to at most this sum, so that no product leaves 64 bits.
WEIGHTS = 1 << 30


def _part(amount, weight, whole):
    """floor(amount * weight / whole) without leaving 64 bits."""
    whole = np.maximum(whole, 1)
    return amount // whole * weight + amount % whole * weight // whole


class _Phase:
    """Shares of the queues that still have tokens, from one token count on.

    The weights are the leaves of a binary tree. Of any amount a node hands
    floor(amount * weight) to its left child and the rest to the right one:
    each queue's total grows by one or not at all with each token, and the
    totals of all queues always sum to the amount.
    """

    def __init__(self, start: int, weights: np.ndarray, served: np.ndarray):
        self.start, self.served = start, served
        self.before = np.cumsum(served) - served
        self.depth = max(1, int(len(weights) - 1).bit_length())
        tree = np.zeros(2 << self.depth, np.int64)
        tree[1 << self.depth : (1 << self.depth) + len(weights)] = weights
        for node in range((1 << self.depth) - 1, 0, -1):
            tree[node] = tree[2 * node] + tree[2 * node + 1]
        self.tree = tree

    def shares(self, amount: np.ndarray, queue: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each amount, what the queue gets and what the queues before it get."""
        node, before = np.ones_like(queue), np.zeros_like(amount)
        for level in range(self.depth - 1, -1, -1):
            left = 2 * node
            part = _part(amount, self.tree[left], self.tree[node])
            right = (queue >> level) & 1
            before = before + part * right
            amount = np.where(right, amount - part, part)
            node = left + right
        return amount, before


class Schedule:
    """Tokens that each queue has served after any number of tokens in all."""

    def __init__(self, totals: list[int], weights: list[float]):
        totals_, wanted = np.array(totals, np.int64), np.array(weights, np.float64)
        if len(totals_) and not (np.isfinite(wanted).all() and (wanted > 0).all()):
            raise ValueError("weights must be positive numbers")
        exact = wanted == np.floor(wanted)
        if not (exact.all() and wanted.sum() <= WEIGHTS):
            wanted = np.maximum(1, np.floor(wanted / wanted.sum() * (WEIGHTS - len(wanted))))
        wanted = wanted.astype(np.int64)
        self.total = int(totals_.sum())
        self.phases: list[_Phase] = []
        served, at, queues = np.zeros_like(totals_), 0, np.arange(len(totals_))
        while at < self.total:
            phase = _Phase(at, np.where(served < totals_, wanted, 0), served)
            low, high = 0, self.total - at
            while low < high:  # the longest phase in which no queue gets more than it has
                middle = (low + high + 1) // 2
                got, _ = phase.shares(np.full_like(totals_, middle), queues)
                low, high = (low, middle - 1) if (got > totals_ - served).any() else (middle, high)
            self.phases.append(phase)
            got, _ = phase.shares(np.full_like(totals_, low), queues)
            served, at = served + got, at + low
        self.starts = np.array([p.start for p in self.phases], np.int64)

    def served(self, tokens: np.ndarray, queue: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """After so many tokens in all: those of the queue, and those of the queues before it."""
        tokens = np.minimum(tokens, self.total)
        which = np.searchsorted(self.starts, tokens, side="right") - 1
        own, before = np.empty_like(tokens), np.empty_like(tokens)
        for number in np.unique(which):
            rows, phase = which == number, self.phases[number]
            got, ahead = phase.shares(tokens[rows] - phase.start, queue[rows])
            own[rows] = phase.served[queue[rows]] + got
            before[rows] = phase.before[queue[rows]] + ahead
        return own, before

    def window_of(self, place: np.ndarray, queue: np.ndarray, window: int) -> np.ndarray:
        """The window that holds the queue's token at each place."""
        low = np.zeros_like(place)
        high = np.full_like(place, max(0, -(-self.total // window) - 1))
        while (low < high).any():
            middle = (low + high + 1) // 2
            own, _ = self.served(middle * window, queue)
            low, high = np.where(own <= place, middle, low), np.where(own <= place, high, middle - 1)
        return low


def token_table(
    df: DataFrame, path: str, queue: Column, end: int = 1, text: str = "text"
) -> DataFrame:
    """Written table of all rows with their ids, their queue and their place in it.

    Adds ``queue`` (a null source is a queue of its own), ``part`` (the task that
    read the row), ``place`` (tokens of the same queue before it in that part),
    ``doc_tokens`` and ``token_ids`` (unsigned 16-bit, ``end`` last). A null or
    empty text is the one id ``end``.
    """
    keyed = df.withColumn("queue", F.coalesce(F.concat(F.lit("="), queue.cast("string")), F.lit("")))
    fields = [
        T.StructField("part", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("token_ids", T.BinaryType()),
    ]
    kept, schema = with_columns(keyed, fields)
    # The text has served its purpose once the ids are there.
    schema = T.StructType([field for field in schema.fields if field.name != text])
    carried = [c for c in kept.columns if c != text]
    last = np.uint16(end).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(path), TaskContext.get().partitionId()
        filled: dict[str, int] = {}
        for batch in slices(batches, text):
            ids = [encoder.encode(x.as_py()) + last for x in column(batch, text)]
            sizes, places = [len(x) // 2 for x in ids], []
            for name, size in zip(column(batch, "queue").to_pylist(), sizes):
                places.append(filled.get(name, 0))
                filled[name] = places[-1] + size
            made = [
                pa.array([part] * len(ids), pa.int64()),
                pa.array(places, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(ids, pa.binary()),
            ]
            kept_columns = batch.select(carried).columns
            yield pa.RecordBatch.from_arrays([*kept_columns, *made], names=schema.names)
        encoder.forget()

    return settle(kept.mapInArrow(run, schema), "tokens")


def pack(
    df: DataFrame,
    path: str,
    source: Column,
    weights: dict[str | None, float] | None = None,
    window: int = WINDOW,
    end: int = 1,
    text: str = "text",
) -> DataFrame:
    """Cut all rows' ids into pieces and lay these out in windows of ``window`` tokens.

    ``weights`` gives each source's share of every window (1 for a source not
    named); by default sources share in proportion to their tokens, so that all
    windows hold the whole mixture. Returns a row per piece: the columns of
    ``df`` but the text (those named like a new one are replaced), ``doc_tokens``, ``start``
    (the row's ids before the piece), ``length``, ``ids`` (little-endian unsigned
    32-bit), ``sequence_id`` and ``offset`` there. All windows are full but the last. Repeated
    rows are packed each on their own; an empty table gives no piece. Beyond
    ``QUEUES`` sources (``WEIGHTED_QUEUES`` with weights) those with the fewest tokens share one
    queue, with their weights' sum, in which one source follows another.
    """
    made = {"doc_tokens", "start", "length", "ids", "sequence_id", "offset", text.lower()}
    given = [c for c in df.columns if c.lower() not in made]
    # Within a struct and under numbers, no name of the caller's can clash.
    boxed = F.struct(F.lit(0).alias("c"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(given)])
    rows = df.select(boxed.alias("carried"), quoted(text).alias("text"), source.alias("source"))
    tokens = token_table(rows, path, F.col("source"), end).drop("source")
    sums = settle(tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("n")), "queue-sums")
    named = {"" if k is None else f"={k}": v for k, v in (weights or {}).items()}
    totals, bases = _queues(sums, named, WEIGHTED_QUEUES if weights else QUEUES)
    schedule = Schedule(
        [n for n, _ in totals], [w for _, w in totals] if weights else [n for n, _ in totals]
    )
    inputs = tokens.join(bases, ["queue", "part"]).select(
        "carried",
        "doc_tokens",
        "number",
        (F.col("queue_base") + F.col("place")).alias("place"),
        "token_ids",
    )
    carried = ["carried", "doc_tokens"]
    schema = T.StructType(
        [
            *[inputs.schema[c] for c in carried],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                queue = column(batch, "number").to_numpy()
                place = column(batch, "place").to_numpy()
                size = column(batch, "doc_tokens").to_numpy()
                row, start, length, sequence, offset = pieces(schedule, queue, place, size, window)
                ids = [np.frombuffer(x.as_buffer(), "<u2").astype("<u4").tobytes()
                       for x in column(batch, "token_ids")]
                cut = [
                    ids[r][4 * s : 4 * (s + n)]
                    for r, s, n in zip(row.tolist(), start.tolist(), length.tolist())
                ]
                kept = batch.select(carried).take(pa.array(row))
                made = [pa.array(start), pa.array(length), pa.array(cut, pa.binary()),
                        pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=schema.names)

    return inputs.mapInArrow(run, schema).select(
        *[F.col(f"carried.c{i}").alias(c) for i, c in enumerate(given)],
        *[field.name for field in schema if field.name != "carried"],
    )


def _queues(
    sums: DataFrame, named: dict[str, float], most: int
) -> tuple[list[tuple[int, float]], DataFrame]:
    """Tokens and weight of each queue, and where each source's parts begin in its queue.

    ``sums`` has the tokens ``n`` of each source (``queue``) and ``part``. Named sources
    come first, then those with the most tokens; sources beyond ``most`` share the last queue.
    The second result has ``queue``, ``part``, ``number`` (of the queue) and ``queue_base``.
    """
    totals = settle(sums.groupBy("queue").agg(F.sum("n").alias("total")), "queue-totals")
    everything = totals.agg(F.count("*").alias("queues"), F.sum("total").alias("n")).first()
    first = [F.col("queue").isin(*named).desc()] if named else []
    order = [*first, F.col("total").desc(), F.col("queue")]
    own = most if everything.queues <= most else most - 1
    listed = totals.orderBy(*order).limit(own).collect()
    listed = sorted(listed, key=lambda row: row.queue)
    found = [(row.total, named.get(row.queue, 1)) for row in listed]
    shared = len(listed)
    if everything.queues > shared:
        known = sum(n for n, _ in found)
        found.append((everything.n - known, everything.queues - shared))
    # As many rows as the driver lists queues.
    numbers = sums.sparkSession.createDataFrame(
        [(row.queue, i) for i, row in enumerate(listed)], "queue string, number bigint"
    )
    placed = totals.join(F.broadcast(numbers), "queue", "left")
    group = F.when(F.col("number").isNull(), F.pmod(F.xxhash64("queue"), F.lit(GROUPS)))
    rest = placed.withColumn("group", group).where("number IS NULL")
    before = (Window.unboundedPreceding, -1)
    # A group's sources are summed in it, groups among each other: GROUPS rows.
    groups = rest.groupBy("group").agg(F.sum("total").alias("in_group"))
    group_base = F.sum("in_group").over(Window.partitionBy(F.lit(0)).orderBy("group").rowsBetween(*before))
    groups = groups.select("group", F.coalesce(group_base, F.lit(0)).alias("group_base"))
    source_base = F.sum("total").over(Window.partitionBy("group").orderBy("queue").rowsBetween(*before))
    starts = rest.withColumn("source_base", F.coalesce(source_base, F.lit(0))).join(groups, "group")
    starts = starts.select("queue", (F.col("group_base") + F.col("source_base")).alias("start"))
    part_base = F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(*before))
    bases = (
        sums.withColumn("part_base", F.coalesce(part_base, F.lit(0)))
        .join(F.broadcast(numbers), "queue", "left")
        .join(starts, "queue", "left")
        .select(
            "queue",
            "part",
            F.coalesce("number", F.lit(shared)).cast("bigint").alias("number"),
            (F.col("part_base") + F.coalesce("start", F.lit(0))).alias("queue_base"),
        )
    )
    return found, settle(bases, "queue-bases")


def pieces(schedule: Schedule, queue, place, size, window: int):
    """Row, start, length, window and offset of each piece of rows at places in queues."""
    first = schedule.window_of(place, queue, window)
    last = schedule.window_of(place + size - 1, queue, window)
    counts = last - first + 1
    row = np.repeat(np.arange(len(size)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    sequence = first[row] + number
    here, ahead = schedule.served(sequence * window, queue[row])
    there, ahead_then = schedule.served((sequence + 1) * window, queue[row])
    begin = np.maximum(here, place[row])
    end = np.minimum(there, (place + size)[row])
    full = end > begin  # a small queue may sit out a window
    offset = ahead_then - ahead + begin - here
    return tuple(x[full] for x in (row, begin - place[row], end - begin, sequence, offset))


def sequences(packed: DataFrame) -> DataFrame:
    """Whole windows of packed pieces: ``sequence_id``, ``n_tokens`` and ``ids``.

    A group is one window, so it holds 2048 ids at most.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(
            ordered, F.lit(b""), lambda whole, piece: F.concat(whole, piece["ids"])
        ).alias("ids"),
    )
