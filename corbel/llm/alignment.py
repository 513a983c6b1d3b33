"""Two tokenizers' tokens of the same texts, aligned by the bytes that they cover.

In a slice of documents each token's first byte finds the other side's token that
covers it (``pandas.merge_asof`` keyed by document, once from either side). Both
directions together are all overlaps; an overlap whose tokens end at the same byte
closes a group. Tokens of both sides in one group are linked, each with each.

How many documents hold a pair of ids linked takes the whole corpus: a slice tells in
how many of its documents each pair occurs, Spark adds these up, and every slice gets
back the counts of its own pairs. A frequent pair is one row for each slice.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corbel.llm.common import column, importable, quoted, settle, slices
from corbel.llm.tokens import byte_ranks

#: Bytes of text in a slice; a longer text is one of its own.
SLICE = 1 << 21

#: Links that are laid out at a time, and in a group before its equal ids are taken together.
LAID_OUT, CROWDED = 1 << 22, 256

_SPACE = "▁"


class Side:
    """A tokenizer: ids of texts, and the bytes that each id stands for."""

    def __init__(self, encode, units: list[bytes]):
        self._encode = encode
        self.units = pa.array(units, pa.large_binary())
        self.sizes = np.array([len(x) for x in units], np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        found = self._encode(texts)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


@functools.lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    """A byte-level vocabulary, special strings as plain text; encodes a blank and the text."""
    coder, units = byte_ranks(path)
    return Side(lambda texts: [coder(" " + x) for x in texts], units)


@functools.lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """A sentencepiece model, which puts a blank before each text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def unit(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return b"" if model.is_control(i) else piece.replace(_SPACE, " ").encode()

    return Side(
        lambda texts: model.encode(texts, num_threads=1), [unit(i) for i in range(len(model))]
    )


@functools.lru_cache(maxsize=2)
def _decimals(n_a: int, n_b: int) -> pa.Array:
    """Ids in decimal with what follows them: A's before A's or B's, B's before B's or A's."""
    return pa.array(
        [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)],
        pa.large_string(),
    )


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for each of ``counts``."""
    return np.arange(int(counts.sum())) - np.repeat(_starts(counts)[:-1], counts)


def covering(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All overlaps of tokens, as rows ``a`` and ``b``, from ``at`` (first byte) by ``doc``."""
    forth = pd.merge_asof(a, b, on="at", by="doc")[["a", "b"]]
    back = pd.merge_asof(b, a, on="at", by="doc")[["a", "b"]]
    return pd.concat([forth, back], ignore_index=True)


class Aligned:
    """Groups of a slice of texts: tokens end to end, and each token's group."""

    def __init__(self, texts: list[str | None], a: Side, b: Side):
        self.sides = a, b
        held = [i for i, x in enumerate(texts) if x]
        ids_a, n_a = a.ids([texts[i] for i in held])
        ids_b, n_b = b.ids([texts[i] for i in held])
        alike = self._alike([texts[i] for i in held], (ids_a, n_a), (ids_b, n_b))
        self.docs = np.array(held, np.int64)[alike]
        self.ids_a, self.ids_b = ids_a[np.repeat(alike, n_a)], ids_b[np.repeat(alike, n_b)]
        self.n_a, self.n_b = n_a[alike], n_b[alike]
        self._group()

    def _alike(self, texts: list[str], *encoded) -> np.ndarray:
        """Which texts both sides give back byte by byte."""
        wanted = [b" " + x.encode() for x in texts]
        fits = np.ones(len(texts), bool)
        for side, (ids, counts) in zip(self.sides, encoded):
            joined = side.units.take(pa.array(ids)).buffers()[2]
            joined = memoryview(joined or b"").cast("B")
            ends = _starts(side.sizes[ids])[_starts(counts)]
            for i, text in enumerate(wanted):
                fits[i] &= joined[ends[i] : ends[i + 1]] == text
        return fits

    def _group(self) -> None:
        frames, ends = [], []
        for name, side, ids, counts in zip(
            "ab", self.sides, (self.ids_a, self.ids_b), (self.n_a, self.n_b)
        ):
            sizes = side.sizes[ids]
            end = np.cumsum(sizes)
            doc = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
            frames.append(pd.DataFrame({"at": end - sizes, "doc": doc, name: np.arange(len(ids))}))
            ends.append(end)
        pairs = covering(*frames)
        at_a, at_b = pairs["a"].to_numpy(np.int64), pairs["b"].to_numpy(np.int64)
        closing = ends[0][at_a] == ends[1][at_b]
        last_a, last_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        last_a[at_a[closing]] = True
        last_b[at_b[closing]] = True
        self.last_a, self.last_b = last_a, last_b
        self.group_a, self.group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        self.sizes_a, self.sizes_b = np.bincount(self.group_a), np.bincount(self.group_b)
        self.n_groups = np.diff(_starts(last_a)[_starts(self.n_a)])
        self.doc_of_group = np.repeat(np.arange(len(self.docs)), self.n_groups)
        self.n_links = np.diff(_starts(self.sizes_a * self.sizes_b)[_starts(self.n_groups)])

    def written(self) -> tuple[pa.Array, memoryview, np.ndarray]:
        """Each group as ``a1,a2|b1``, all of them as one buffer, and where the documents begin in it."""
        n_a, n_b = (len(side.units) for side in self.sides)
        lines = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        place_a = np.arange(len(self.ids_a)) + _starts(self.sizes_b)[self.group_a]
        place_b = np.arange(len(self.ids_b)) + _starts(self.sizes_a)[self.group_b + 1]
        lines[place_a] = self.ids_a + n_a * self.last_a
        lines[place_b] = self.ids_b + n_b * self.last_b + 2 * n_a
        shown = _decimals(n_a, n_b).take(pa.array(lines))
        _, offsets, data = shown.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(lines) + 1]
        groups = offsets[_starts(self.sizes_a + self.sizes_b)]
        data = data or pa.py_buffer(b"")
        whole = pa.LargeStringArray.from_buffers(
            len(groups) - 1, pa.py_buffer(np.ascontiguousarray(groups)), data
        )
        return whole, memoryview(data), groups[_starts(self.n_groups)]

    def kinds(self, groups: pa.Array):
        """Equal groups once: each group's kind, and each kind's pairs of ids with their counts.

        Pairs are ``(a << 32) + b``; the result is (kind of each group, kind of each
        entry, its pair, its links).
        """
        coded = groups.dictionary_encode()
        kind = coded.indices.to_numpy().astype(np.int64)
        n = len(coded.dictionary)
        first = np.zeros(n, np.int64)
        first[kind[::-1]] = np.arange(len(kind))[::-1]
        begin_a, begin_b = _starts(self.sizes_a)[first], _starts(self.sizes_b)[first]
        many_a, many_b = self.sizes_a[first], self.sizes_b[first]
        crowded = many_a * many_b > CROWDED
        found = [self._laid_out(np.flatnonzero(~crowded), begin_a, begin_b, many_a, many_b)]
        for k in np.flatnonzero(crowded).tolist():
            a, times_a = np.unique(
                self.ids_a[begin_a[k] : begin_a[k] + many_a[k]], return_counts=True
            )
            b, times_b = np.unique(
                self.ids_b[begin_b[k] : begin_b[k] + many_b[k]], return_counts=True
            )
            pairs = ((a << 32)[:, None] + b).ravel()
            found.append((np.full(len(pairs), k), pairs, np.outer(times_a, times_b).ravel()))
        return kind, *(np.concatenate(x) for x in zip(*found))

    def _laid_out(self, few, begin_a, begin_b, many_a, many_b):
        many = many_a[few] * many_b[few]
        inner = _within(many)
        wide = np.repeat(many_b[few], many)
        a = self.ids_a[np.repeat(begin_a[few], many) + inner // wide]
        b = self.ids_b[np.repeat(begin_b[few], many) + inner % wide]
        return np.repeat(few, many), (a << 32) + b, np.ones(len(inner), np.int64)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(values[order], first) if len(first) else values[:0]


class Tally:
    """A slice's documents by kinds of groups, and kinds by pairs of ids."""

    def __init__(self, aligned: Aligned, groups: pa.Array):
        kind, entry_kind, entry_pair, links = aligned.kinds(groups)
        n = len(entry_kind) and int(entry_kind.max()) + 1
        met = np.unique(entry_pair)
        at = np.searchsorted(met, entry_pair)
        cells, links = _summed(entry_kind * max(1, len(met)) + at, links)
        self.pairs = met
        self.entry_kind, self.entry_at = np.divmod(cells, max(1, len(met)))
        self.entry_links = links
        cells, times = _summed(aligned.doc_of_group * max(1, n) + kind, np.ones(len(kind), np.int64))
        self.doc, self.kind = np.divmod(cells, max(1, n))
        self.times, self.n_kinds = times, n

    def documents(self) -> np.ndarray:
        """In how many of the slice's documents each pair occurs."""
        counts = np.zeros(len(self.pairs), np.int64)
        begin = np.searchsorted(self.entry_kind, np.arange(self.n_kinds + 1))
        many = np.diff(begin)[self.kind] if self.n_kinds else np.zeros(0, np.int64)
        ends, first = _starts(many), 0
        while first < len(many):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + LAID_OUT)) - 1)
            if last < len(many):  # whole documents, so that none counts a pair twice
                whole = int(np.searchsorted(self.doc, self.doc[last]))
                if whole <= first:
                    whole = int(np.searchsorted(self.doc, self.doc[first], side="right"))
                last = whole
            n = many[first:last]
            at = self.entry_at[np.repeat(begin[self.kind[first:last]], n) + _within(n)]
            cells = np.unique(np.repeat(self.doc[first:last], n) * len(self.pairs) + at)
            counts += np.bincount(cells % len(self.pairs), minlength=len(self.pairs))
            first = last
        return counts

    def packed(self) -> bytes:
        """All of it in few bytes, for :func:`_sums`."""
        parts = [self.entry_kind, self.entry_at, self.entry_links, self.doc, self.kind, self.times]
        flat = np.concatenate(parts).astype(np.int64)
        flat = flat.astype(np.uint32) if not len(flat) or flat.max() < 1 << 32 else flat
        head = [len(self.entry_kind), len(self.doc), self.n_kinds, flat.itemsize, flat.nbytes]
        body = pa.compress(flat.tobytes(), codec="zstd", asbytes=True)
        return np.array(head, np.int64).tobytes() + body


def _sums(packed: bytes, n_docs: int, values: list[np.ndarray]) -> list[np.ndarray]:
    """Per document, the sums over its links of values known for each pair."""
    entries, cells, n_kinds, width, size = np.frombuffer(packed, np.int64, 5).tolist()
    body = pa.decompress(packed[40:], size, codec="zstd", asbytes=True)
    flat = np.frombuffer(body, np.uint32 if width == 4 else np.int64).astype(np.int64)
    bounds = _starts(np.array([entries] * 3 + [cells] * 3))
    entry_kind, entry_at, links, doc, kind, times = (
        flat[x:y] for x, y in zip(bounds[:-1], bounds[1:])
    )
    sums = []
    for value in values:
        each = _added(entry_kind, links * value[entry_at], n_kinds)
        sums.append(_added(doc, times * each[kind], n_docs))
    return sums


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values by place; places are in order."""
    ends = _starts(values)
    return ends[np.searchsorted(at, np.arange(1, size + 1))] - ends[np.searchsorted(at, np.arange(size))]


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Each document's alignment of two tokenizers, as counts, digest and links by frequency.

    ``path_a`` is a byte-level vocabulary, ``path_b`` a sentencepiece model. Returns all
    columns but ``text`` (those named like a new one are replaced), and ``n_a``, ``n_b``
    (tokens), ``n_groups``, ``n_links`` (pairs of tokens that share a group),
    ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``), ``n_best`` (links whose pair of ids is, of
    all pairs with this A id, in the most documents; ties too) and ``count_sum`` (over the
    links, documents that hold the pair linked).

    Every row is a document, repeated ones too. A text that is null, empty or not given
    back byte by byte by both sides has no tokens: zeros and an empty digest. An empty
    table gives no row.
    """
    importable(df.sparkSession)
    new = {*(field.name for field in _MADE), *_SUMS, text.lower()}
    carried = [x for x in df.columns if x.lower() not in new]
    # Within a struct and under numbers, no name of the caller's can clash.
    rows = df.select(
        F.struct(F.lit(0).alias("c"), *[quoted(x).alias(f"c{i}") for i, x in enumerate(carried)])
        .alias("carried"),
        quoted(text).alias("text"),
    )
    met = settle(_slices(rows, path_a, path_b), "alignments")
    counts = settle(
        met.select(F.inline(F.arrays_zip("pair", "documents")))
        .groupBy("pair")
        .agg(F.sum("documents").alias("n"))
        .withColumn("a", F.shiftright("pair", 32)),
        "link-counts",
    )
    # One row for each id of a vocabulary at most.
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    known = counts.join(F.broadcast(top), "a").select(
        "pair", "n", (F.col("n") == F.col("top")).alias("best")
    )
    answers = (
        met.select(F.col("slice").alias("asked"), F.posexplode("pair").alias("at", "pair"))
        .join(known, "pair")
        .select("asked", "at", "n", "best")
    )
    return _summed_up(met.select("slice", "rows", "packed"), answers).select(
        *[F.col(f"row.carried.c{i}").alias(x) for i, x in enumerate(carried)],
        *[F.col(f"row.{field.name}").alias(field.name) for field in _MADE],
        *_SUMS,
    )


_MADE = [
    *(T.StructField(x, T.LongType()) for x in ("n_a", "n_b", "n_groups", "n_links")),
    T.StructField("groups_sha256", T.StringType()),
]
_SUMS = ("n_best", "count_sum")


def _slices(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each slice: its documents' rows, and its pairs with the documents that hold them."""
    row = T.StructType([rows.schema["carried"], *_MADE])
    schema = T.StructType(
        [
            T.StructField("slice", T.LongType()),
            T.StructField("rows", T.ArrayType(row)),
            T.StructField("pair", T.ArrayType(T.LongType())),
            T.StructField("documents", T.ArrayType(T.LongType())),
            T.StructField("packed", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    row_type = arrow.field("rows").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(path_a), piece_side(path_b)
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(slices(batches, "text", SLICE)):
            aligned = Aligned(column(batch, "text").to_pylist(), a, b)
            tally, made = measured(aligned, batch.num_rows)
            fields = [column(batch, "carried"), *made]
            whole = pa.StructArray.from_arrays(
                [x.cast(f.type) for x, f in zip(fields, row_type)], fields=list(row_type)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number], pa.int64()),
                    _listed(whole, arrow.field("rows").type),
                    _listed(pa.array(tally.pairs), arrow.field("pair").type),
                    _listed(pa.array(tally.documents()), arrow.field("documents").type),
                    pa.array([tally.packed()], pa.binary()),
                ],
                schema=arrow,
            )

    return rows.mapInArrow(run, schema)


def _listed(values: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(kind)


def measured(aligned: Aligned, n_docs: int) -> tuple[Tally, list[pa.Array]]:
    """The tally of a slice, and its documents' counts and digests."""
    groups, data, ends = aligned.written()
    made = []
    for found in (aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links):
        counts = np.zeros(n_docs, np.int64)
        counts[aligned.docs] = found
        made.append(pa.array(counts))
    digests = [""] * n_docs
    for doc, begin, end in zip(aligned.docs.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
        digests[doc] = hashlib.sha256(data[begin : end - 1]).hexdigest()
    return Tally(aligned, groups), [*made, pa.array(digests, pa.string())]


def _summed_up(met: DataFrame, answers: DataFrame) -> DataFrame:
    """The documents' rows, with sums over the counts that their slices got back."""
    row = met.schema["rows"].dataType.elementType
    schema = T.StructType(
        [T.StructField("row", row), *(T.StructField(x, T.LongType()) for x in _SUMS)]
    )
    arrow = to_arrow_schema(schema)

    def run(slice_: pa.Table, known: pa.Table) -> pa.Table:
        if not slice_.num_rows:
            return arrow.empty_table()
        rows = slice_["rows"].combine_chunks()
        rows = (rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows).flatten()
        doc = rows.field("carried")  # as many as documents
        at = known["at"].to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = known["n"].to_numpy(), known["best"].to_numpy(zero_copy_only=False)
        # A document's cells lie by their place among those that have tokens.
        held = np.flatnonzero(rows.field("n_a").to_numpy() > 0)
        sums = [np.zeros(len(doc), np.int64) for _ in _SUMS]
        for total, found in zip(sums, _sums(slice_["packed"][0].as_py(), len(held), [best, n])):
            total[held] = found
        return pa.Table.from_arrays([rows, *map(pa.array, sums)], schema=arrow)

    return met.groupBy("slice").cogroup(answers.groupBy("asked")).applyInArrow(run, schema)
