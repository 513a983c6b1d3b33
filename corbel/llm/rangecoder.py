"""Token ids in files of compressed blocks: a range coder driven by mixed id predictions.

A block is coded on its own: the model starts afresh, and the block carries
checksums. Its ids are laid out as up to 4096 lanes that are coded side by
side, each by its own 64-bit range coder, under one model that all lanes teach.
For each id the model mixes three predictions with whole-number weights:

* order 0: adaptive frequencies of all ids,
* order 1: the id that last followed the id before, with a confidence,
* order 2: the id that last followed the two ids before (hashed), likewise.

The weights are learned from how often each prediction came true at its
confidences. Only integer arithmetic is used, so any machine decodes what any
other has encoded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corbel.llm.common import column, quoted, settle
from corbel.llm.tokens import byte_encoder

MAGIC = b"CMR1"
BLOCK_IDS = 1 << 20
LANES = 1 << 12
LANE_IDS = 1 << 8

#: Frequency added per id; frequencies are halved when their sum passes the limit.
STEP, LIMIT = np.int32(32), 1 << 22
#: Frequencies are summed anew at each of the first steps, then at every eighth.
FRESH, EVERY = 16, 8
#: Steps of the guide to the frequencies, as a power of two, and the lookups that are worth one.
GUIDE_BITS, GUIDED = 15, 1 << 9
CONTEXTS = 1 << 16
SURE = 3
SHARE = 248
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
UNIT = np.uint64(16)


def lanes_of(ids: int) -> tuple[int, int]:
    """Number of lanes and ids a lane; the last lane may be shorter."""
    if not ids:
        return 0, 0
    steps = -(-ids // min(LANES, max(1, ids // LANE_IDS)))
    return -(-ids // steps), steps


#: A table's entry holds an id above its confidence.
ID_BITS, CONFIDENCES = 3, SURE + 2
#: The confidence that follows, by the one before and whether the id came true.
NEXT = np.array(
    [
        min(sure + 1, SURE + 1) if right and sure else max(sure - 1, 1)
        for sure in range(CONFIDENCES)
        for right in (False, True)
    ],
    np.int32,
)
#: For each pair of confidences, whether order 2 and order 1 hold an id.
HELD2, HELD1 = (np.divmod(np.arange(CONFIDENCES**2), CONFIDENCES)[i] > 0 for i in (0, 1))


def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The table's entries at places that it has; the mode spares a check of each."""
    return table.take(places, mode="clip")


class Model:
    """Mixed predictions for all lanes of one block; coder and decoder run it alike.

    Shares of the total stay below 2**30 (at most 256 times :data:`LIMIT` or the symbols), so
    they are 32-bit numbers, and weights depend on the pair of confidences alone.
    """

    def __init__(self, symbols: int, lanes: int):
        self.counts = np.ones(symbols, np.int32)
        self.below = np.zeros(symbols + 1, np.int32)
        self.first = np.zeros(symbols, np.int32)
        self.second = np.zeros(CONTEXTS, np.int32)
        # Per pair of confidences: times seen, order 2 right, order 1 alone right.
        self.seen = np.ones((3, CONFIDENCES**2), np.int64)
        self.seen[0] = 4
        self.last, self.earlier = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0

    def _weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of order 1 and order 2 for each pair of confidences."""
        seen, right2, right1 = self.seen
        weight2 = SHARE * right2 // seen * HELD2
        weight1 = (SHARE - weight2) * right1 // seen * HELD1
        return weight1.astype(np.int32), weight2.astype(np.int32)

    def predict(self, lanes: int) -> None:
        if self.step < FRESH or self.step % EVERY == 0:
            np.cumsum(self.counts, out=self.below[1:])
            if self.below[-1] > LIMIT:
                self.counts = (self.counts + 1) >> 1
                np.cumsum(self.counts, out=self.below[1:])
            self.freq, self.guide = self.counts.copy(), None
        self.one, earlier = self.last[:lanes], self.earlier[:lanes]
        self.two = ((earlier * 0x9E3779B1 + self.one * 0x85EBCA77) >> 8) & (CONTEXTS - 1)
        held1, held2 = _at(self.first, self.one), _at(self.second, self.two)
        self.id1, self.sure1 = held1 >> ID_BITS, held1 & (2**ID_BITS - 1)
        self.id2, self.sure2 = held2 >> ID_BITS, held2 & (2**ID_BITS - 1)
        self.state = (self.sure2 * CONFIDENCES + self.sure1).astype(np.intp)
        whole = self.below[-1]
        weight1, weight2 = self._weights()
        self.rest = _at(256 - weight1 - weight2, self.state)
        self.mass1 = _at(weight1 * whole, self.state)
        self.mass2 = _at(weight2 * whole, self.state)
        self.total = np.uint64(int(whole) * 256)

    def span(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each id's share of the total begins, and its size."""
        small = ids.astype(np.int32)
        start, size = self.rest * _at(self.below, ids), self.rest * _at(self.freq, ids)
        start += self.mass1 * (self.id1 < small)
        start += self.mass2 * (self.id2 < small)
        size += self.mass1 * (self.id1 == small)
        size += self.mass2 * (self.id2 == small)
        return start, size

    def _holding(self, places: np.ndarray) -> np.ndarray:
        """The id whose frequencies hold each place.

        A guide knows the id that holds the first place of each of many even steps; where the
        place lies past that id's frequencies it is searched for.
        """
        if len(places) < GUIDED:
            return np.searchsorted(self.below, places, side="right") - 1
        shift = max(0, int(self.below[-1]).bit_length() - GUIDE_BITS)
        if self.guide is None:
            steps = (self.below + ((1 << shift) - 1)) >> shift
            self.guide = np.cumsum(np.bincount(steps)) - 1
        ids = _at(self.guide, places >> shift)
        past = np.flatnonzero(places >= _at(self.below, ids + 1))
        ids[past] = np.searchsorted(self.below, _at(places, past), side="right") - 1
        return ids

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose share holds each point, where that share begins, and its size.

        Only points outside of the shares of both predicted ids are looked up.
        """
        same = self.id1 == self.id2
        start1 = self.rest * _at(self.below, self.id1) + self.mass2 * (self.id2 < self.id1)
        start2 = self.rest * _at(self.below, self.id2) + self.mass1 * (self.id1 < self.id2)
        size1 = self.rest * _at(self.freq, self.id1) + self.mass1 + self.mass2 * same
        size2 = self.rest * _at(self.freq, self.id2) + self.mass2 + self.mass1 * same
        past1, past2 = at >= start1 + size1, at >= start2 + size2
        hit2 = (at >= start2) & ~past2
        ids = np.where(hit2, self.id2, self.id1).astype(np.intp)
        start, size = np.where(hit2, start2, start1), np.where(hit2, size2, size1)
        missed = np.flatnonzero(~(hit2 | (at >= start1) & ~past1))
        if len(missed):
            moved = _at(self.mass1 * past1 + self.mass2 * past2, missed)
            rest = _at(self.rest, missed)
            found = self._holding((_at(at, missed) - moved) // rest)
            ids[missed] = found
            start[missed] = rest * _at(self.below, found) + moved
            size[missed] = rest * _at(self.freq, found)
        return ids, start, size

    def learn(self, ids: np.ndarray) -> None:
        small = ids.astype(np.int32)
        right1, right2 = self.id1 == small, self.id2 == small
        np.add.at(self.counts, ids, STEP)
        pairs = CONFIDENCES**2
        outcome = np.where(right2, pairs, right1 * np.int64(2 * pairs))
        came = np.bincount(self.state + outcome, minlength=3 * pairs).reshape(3, pairs)
        self.seen[0] += came.sum(axis=0)
        self.seen[1:] += came[1:]
        for table, where, held, sure, right in (
            (self.first, self.one, self.id1, self.sure1, right1),
            (self.second, self.two, self.id2, self.sure2, right2),
        ):
            # Confidence 0: nothing held yet; 1: held, and lost at the next miss.
            kept = np.where(sure > 1, held, small)
            table[where] = kept << ID_BITS | _at(NEXT, sure * 2 + right)
        self.last, self.earlier = ids, self.one
        self.step += 1


def _active(ids: int, lanes: int, steps: int) -> Iterator[int]:
    """Lanes that still have an id at each step."""
    short = ids - (lanes - 1) * steps
    for step in range(steps):
        yield lanes if step < short else lanes - 1


def _shifting(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Lanes whose top 16 bits are settled, or whose range must be cut short."""
    settled = (low ^ (low + span)) < TOP
    narrow = ~settled & (span < BOTTOM)
    if narrow.any():
        span[narrow] = -low[narrow] & (BOTTOM - np.uint64(1))
    return np.flatnonzero(settled | narrow)


def _shift(low: np.ndarray, span: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Move lanes on by 16 bits until none has settled ones: the lanes, and what their low was."""
    moved = _shifting(low, span)
    lows, spans = _at(low, moved), _at(span, moved)
    while len(moved):
        yield moved, lows
        lows, spans = lows << UNIT, spans << UNIT
        again = _shifting(lows, spans)
        low[moved], span[moved] = lows, spans
        moved, lows, spans = _at(moved, again), _at(lows, again), _at(spans, again)


def encode_ids(ids: np.ndarray, symbols: int) -> bytes:
    """Compressed ids, with the lane sizes in front."""
    lanes, steps = lanes_of(len(ids))
    if not lanes:
        return b""
    # A row for each step; the places that the last lane lacks are not coded.
    laid = np.zeros(lanes * steps, np.int64)
    laid[: len(ids)] = ids
    laid = np.ascontiguousarray(laid.reshape(lanes, steps).T)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    owners, units = [], []
    model = Model(symbols, lanes)

    def emit(moved: np.ndarray, lows: np.ndarray) -> None:
        owners.append(moved.astype(np.uint16))
        units.append((lows >> np.uint64(48)).astype("<u2"))

    for step, active in enumerate(_active(len(ids), lanes, steps)):
        now = laid[step, :active]
        model.predict(active)
        start, size = model.span(now)
        part = span[:active] // model.total
        low[:active] += part * start.astype(np.uint64)
        span[:active] = part * size.astype(np.uint64)
        for moved, lows in _shift(low[:active], span[:active]):
            emit(moved, lows)
        model.learn(now)
    for _ in range(4):
        emit(np.arange(lanes), low)
        low <<= UNIT
    owner = np.concatenate(owners)
    # Stable, so each lane's units stay in their order.
    streams = np.concatenate(units)[np.argsort(owner, kind="stable")]
    return np.bincount(owner, minlength=lanes).astype("<u4").tobytes() + streams.tobytes()


def decode_ids(data: bytes, count: int, symbols: int) -> np.ndarray:
    lanes, steps = lanes_of(count)
    if not lanes:
        return np.zeros(0, np.int64)
    sizes = np.frombuffer(data, "<u4", lanes).astype(np.int64)
    stream = np.frombuffer(data, "<u2", offset=4 * lanes)
    at = np.cumsum(sizes) - sizes
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = code << UNIT | stream[at]
        at += 1
    model, laid = Model(symbols, lanes), np.zeros((steps, lanes), np.int64)
    for step, active in enumerate(_active(count, lanes, steps)):
        model.predict(active)
        part = span[:active] // model.total
        point = np.minimum((code[:active] - low[:active]) // part, model.total - np.uint64(1))
        now, start, size = model.find(point.astype(np.int32))
        low[:active] += part * start.astype(np.uint64)
        span[:active] = part * size.astype(np.uint64)
        for moved, _ in _shift(low[:active], span[:active]):
            place = _at(at, moved)
            code[moved] = _at(code, moved) << UNIT | stream.take(place)
            at[moved] = place + 1
        laid[step, :active] = now
        model.learn(now)
    return laid.T.reshape(-1)[:count]


_HEAD = struct.Struct("<4sIQQI")


def pack_block(docs: list[tuple[int | None, bytes]], symbols: int) -> bytes:
    """One block of whole documents: head, ids of documents, their sizes, coded ids, checksum.

    A null document id is kept as such.
    """
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u2")
    names = np.array([0 if d is None else d for d, _ in docs], "<i8").tobytes()
    named = np.array([d is not None for d, _ in docs], np.uint8).tobytes()
    sizes = np.array([len(x) // 2 for _, x in docs], "<u8").tobytes()
    head = _HEAD.pack(MAGIC, len(docs), len(ids), symbols, zlib.crc32(ids.astype("<u4")))
    body = head + names + named + sizes + encode_ids(ids, symbols)
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their sizes and all token ids; raises if a checksum doesn't hold."""
    body, (check,) = block[:-4], struct.unpack("<I", block[-4:])
    if zlib.crc32(body) != check:
        raise ValueError("a block of token ids is damaged")
    magic, docs, count, symbols, ids_check = _HEAD.unpack_from(body)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = _HEAD.size
    names = np.frombuffer(body, "<i8", docs, at).tolist()
    named = np.frombuffer(body, np.uint8, docs, at + 8 * docs)
    sizes = np.frombuffer(body, "<u8", docs, at + 9 * docs).astype(np.int64)
    ids = decode_ids(body[at + 17 * docs :], count, symbols).astype("<u4")
    if zlib.crc32(ids) != ids_check:
        raise ValueError("a block of token ids doesn't decode to what was written")
    return [x if y else None for x, y in zip(names, named)], sizes, ids


def write_ids(
    df: DataFrame, path: str, end: int = 0, text: str = "text", key: str = "doc_id",
    target: str | None = None,
) -> DataFrame:
    """Write the token ids of every text, in ascending order of ``key``, as coded blocks.

    The files go to the folder ``target``, which must not exist yet, and stay there; without
    one they go to the shared scratch folder and are gone when the application ends.

    Rows are dealt out by ranges of the key, null first; rows with equal keys
    follow by a hash of the text. Each text's ids end with ``end``; a null or empty text is
    that one id. A block holds whole documents, 2**20 ids and what the last one
    adds. Returns the written table: ``part`` (its place among the ranges),
    ``part_start`` (ids before the block within the part), ``n_ids``, ``block``.
    """
    narrow = df.select(quoted(key).cast("bigint").alias("key"), quoted(text).alias("text"))
    # The second column divides a key that very many rows share.
    narrow = narrow.withColumn("tie", F.xxhash64("text"))
    ordered = narrow.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").drop("tie")
    last = np.uint16(end).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        symbols = _symbols(path)
        part = TaskContext.get().partitionId()
        docs: list[tuple[int | None, bytes]] = []
        held = before = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, held, before
            made = [[part], [before], [held], [pack_block(docs, symbols)]]
            docs, before, held = [], before + held, 0
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(made, kinds)],
                names=["part", "part_start", "n_ids", "block"],
            )

        for batch in batches:
            for name, value in zip(column(batch, "key"), column(batch, "text")):
                ids = encoder.encode(value.as_py()) + last
                docs.append((name.as_py(), ids))
                held += len(ids) // 2
                if held >= BLOCK_IDS:
                    yield flush()
        if docs:
            yield flush()

    schema = "part bigint, part_start bigint, n_ids bigint, block binary"
    coded = ordered.mapInArrow(run, schema)
    if target is None:
        return settle(coded, "token-ids")
    coded.write.mode("error").parquet(target)
    return df.sparkSession.read.schema(schema).parquet(target)


def _symbols(path: str) -> int:
    from corbel.llm.tokens import tokenizer

    return tokenizer(path).get_vocab_size()


def read_ids(written: DataFrame) -> DataFrame:
    """Documents of written blocks: ``key``, ``start`` (ids before), ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each written range, not for each document.
    bases = parts.select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_base")
    )
    placed = written.join(bases, "part").select(
        (F.col("part_base") + F.col("part_start")).alias("start"), "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in zip(column(batch, "start"), column(batch, "block")):
                names, sizes, ids = unpack_block(block.as_py())
                ends = np.cumsum(sizes)
                pieces = [ids[e - n : e].tobytes() for e, n in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(start.as_py() + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(run, "key bigint, start bigint, n_tokens bigint, ids binary")
