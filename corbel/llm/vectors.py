"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one kept per group.

Equal vectors are one class from the start. Centroids are fitted to a bounded
sample of classes; every class is at home in the cell of its nearest centroid
and visits cells whose border is near. Within a cell members are dealt into
blocks - those at home and guests apart - and each pair of blocks is one matrix
product, so no cell has to fit in a task, and guests never meet guests. A pair seen in two cells counts in the first only. A block hands on
each vector's number of links and a spanning forest of its links, never the
pairs themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, importable, map_batches, quoted, settle
from corbel.llm.components import components

#: Classes that centroids are fitted to, wanted members of a cell, most cells, rounds.
SAMPLE, CELL, MOST_CELLS, ROUNDS = 16_384, 512, 2_048, 6
#: How near a border must be for a visit, in standard deviations of how far a vector at the
#: threshold strays in one direction, if it strays as its surroundings do.
REACH = 2.0
#: Sample vectors around a centroid that tell in how many directions these reach.
AROUND = 256
BLOCK = 1_024


def _classes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key``, ``node`` (a name of the vector's value, null if it links with nothing) and ``unit``."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        nodes, units = [], []
        for value in column(batch, "vector"):
            numbers = np.array(value.as_py() or [], dtype=object)
            usable = len(numbers) and all(x is not None for x in numbers)
            numbers = numbers.astype(np.float64) + 0.0 if usable else np.zeros(1)
            size = np.sqrt(numbers @ numbers) if np.isfinite(numbers).all() else 0.0
            if not 0 < size < np.inf:
                # Very large or small components: scale before squaring.
                largest = np.abs(numbers).max()
                if not 0 < largest < np.inf:
                    nodes.append(None)
                    units.append(None)
                    continue
                numbers = numbers / largest
                size = np.sqrt(numbers @ numbers)
            unit = (numbers / size).tobytes()
            digest = hashlib.blake2b(unit, digest_size=8).digest()
            nodes.append(int.from_bytes(digest, "little", signed=True))
            units.append(unit)
        return [pa.array(nodes, pa.int64()), pa.array(units, pa.binary())]

    named = df.select(quoted(key).cast("bigint").alias("key"), quoted(vector).alias("vector"))
    fields = [T.StructField("node", T.LongType()), T.StructField("unit", T.BinaryType())]
    return map_batches(named, fields, compute).drop("vector")


def centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids of unit rows by spherical k-means; the first rows start it."""
    found = sample[:cells].copy()
    for _ in range(ROUNDS):
        home = np.argmax(sample @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, home, sample)
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(sizes > 1e-12, sums / np.maximum(sizes, 1e-12), found)
    return found


def farthest(threshold: float) -> float:
    """Share of the centroids' distance beyond which no visit finds a pair.

    Of two linked vectors on both sides of a border, the nearer one is at most half their own
    distance away from it, so visits up to there find every pair.
    """
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-9)


def reaches(sample: np.ndarray, centres: np.ndarray, threshold: float) -> np.ndarray:
    """For each cell, up to what share of the centroids' distance its vectors visit.

    Vectors that spread in few directions stray further along each. Around each centroid the
    number of directions is taken from its nearest sample vectors.
    """
    most, stray = farthest(threshold), np.sqrt(max(0.0, 1 - threshold**2))
    found = np.empty(len(centres))
    for cell, centre in enumerate(centres):
        near = sample @ centre
        some = sample[np.argpartition(-near, AROUND)[:AROUND]] if len(sample) > AROUND else sample
        spread = np.linalg.svd(some - some.mean(axis=0), compute_uv=False) ** 2
        directions = spread.sum() ** 2 / max((spread**2).sum(), 1e-300)
        found[cell] = min(most, REACH * stray / np.sqrt(max(1e-9, directions - 1)))
    return found


def visits(units: np.ndarray, centres: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home of each row, and which other cells it visits (rows by cells)."""
    near = units @ centres.T
    home = np.argmax(near, axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    ahead = near[np.arange(len(units)), home][:, None] - near
    close = ahead <= reach[home][:, None] * apart
    close[np.arange(len(units)), home] = False
    return home, close


def _members(classes: DataFrame, models: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """A row for each class and cell: ``cell``, ``node``, ``unit``, ``copies``, ``home``, ``others``."""
    held = classes.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                size = np.array([len(x.as_buffer()) for x in column(batch, "unit")])
                for length in np.unique(size):
                    rows = np.flatnonzero(size == length)
                    own = batch.take(pa.array(rows))
                    yield members(own, int(length) // 8, held.value)

    def members(batch: pa.RecordBatch, dimensions: int, known: dict) -> pa.RecordBatch:
        units = _matrix(column(batch, "unit"), dimensions)
        home, close = visits(units, *known.get(dimensions, (np.zeros((1, dimensions)), np.zeros(1))))
        others = [np.flatnonzero(x) for x in close]
        row = np.concatenate([np.arange(len(units)), *[np.full(len(x), i) for i, x in enumerate(others)]])
        cell = np.concatenate([home, *others]).astype(np.int64)
        kept = batch.take(pa.array(row.astype(np.int64)))
        made = [
            pa.array([f"{dimensions}:{c}" for c in cell.tolist()]),
            column(kept, "node"),
            column(kept, "unit"),
            column(kept, "copies"),
            pa.array(home[row].astype(np.int32)),
            # Only needed of those at home.
            pa.array(
                [others[r].astype(np.int32) if n < len(units) else None for n, r in enumerate(row)],
                pa.list_(pa.int32()),
            ),
            pa.array(cell.astype(np.int32)),
        ]
        names = ["cell", "node", "unit", "copies", "home", "others", "here"]
        return pa.RecordBatch.from_arrays(made, names=names)

    schema = (
        "cell string, node bigint, unit binary, copies bigint, home int, others array<int>, here int"
    )
    return classes.select("node", "unit", "copies").mapInArrow(run, schema)


def _matrix(units: pa.Array, dimensions: int) -> np.ndarray:
    joined = b"".join(x.as_buffer() for x in units)
    return np.frombuffer(joined, np.float64).reshape(-1, dimensions)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns of a table of links; equal if links connect them."""
    rows = np.arange(linked.shape[0])
    if not linked.any():
        return rows, np.full(linked.shape[1], -1)
    columns = np.where(linked.any(axis=0), np.argmax(linked, axis=0), -1)
    most = len(rows)
    while True:
        reach = np.where(linked, columns[None, :], most).min(axis=1, initial=most)
        lower = np.minimum(rows, reach)
        reach = np.where(linked, lower[:, None], most).min(axis=0, initial=most)
        low = np.where(reach < most, reach, -1)
        if (lower == rows).all() and (low == columns).all():
            return rows, columns
        rows, columns = lower, low


def _block_links(table: pa.Table, threshold: float) -> pa.Table:
    """Links of two blocks of one cell (or within one): ``node``, ``n_links``, ``root``."""
    table = table.combine_chunks()
    first, second = (table.column(c)[0].as_py() for c in ("first", "second"))
    block = table.column("block").to_numpy()
    nodes = table.column("node").to_numpy()
    units = _matrix(table.column("unit"), len(table.column("unit")[0].as_buffer()) // 8)
    home, here = table.column("home").to_numpy(), table.column("here").to_numpy()
    copies = table.column("copies").to_numpy()
    if table.column("guests")[0].as_py():
        a, b = np.flatnonzero(home == here), np.flatnonzero(home != here)
    else:
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
    linked = units[a] @ units[b].T >= threshold
    if table.column("guests")[0].as_py():
        others = table.column("others")
        for i in np.flatnonzero(linked.any(axis=1)):
            # Where the host is a guest at the guest's home, the smaller cell counts the pair.
            elsewhere = home[b][linked[i]]
            twice = (elsewhere < here[a[i]]) & np.isin(elsewhere, others[int(a[i])].as_py())
            linked[i, np.flatnonzero(linked[i])[twice]] = False
    elif first == second:
        linked &= np.triu(np.ones(linked.shape, bool), 1)
    rows, columns = forest(linked)
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, a, linked @ copies[b])
    np.add.at(links, b, linked.T @ copies[a])
    made_node = np.concatenate([nodes[a], nodes[b][columns >= 0]])
    made_root = np.concatenate([nodes[a][rows], nodes[a][columns[columns >= 0]]])
    tied = made_node != made_root
    counted = links > 0
    return pa.table(
        {
            "node": np.concatenate([made_node[tied], nodes[counted]]),
            "root": np.concatenate([made_root[tied], nodes[counted]]),
            "n_links": np.concatenate([np.zeros(int(tied.sum()), np.int64), links[counted]]),
        }
    )


def link_vectors(
    df: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding",
    exact: bool = False,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of all rows.

    Two vectors of equal length link if their cosine, in double precision, is at
    least ``threshold``; equal vectors always do. Null, empty and zero vectors and
    those with null or non-finite components link with nothing. ``component_id`` is
    the smallest key that links reach, ``kept`` marks the row that has it. No pair
    below the threshold is linked; a pair at it may be missed if a cell border
    runs between (``tests/llm`` and the README have the recall), unless ``exact`` is set,
    which makes vectors visit every cell that could hold a partner. Repeated
    rows are rows of their own; other columns play no part; an empty table gives no row.
    """
    importable(df.sparkSession)
    rows = settle(_classes(df, key, vector), "vectors")
    usable = rows.where("node IS NOT NULL")
    classes = settle(
        usable.groupBy("node").agg(
            F.min("key").alias("smallest"), F.count("*").alias("copies"), F.first("unit").alias("unit")
        ),
        "vector-classes",
    )
    total = classes.count()
    sample = classes.select("node", "unit").orderBy("node").limit(SAMPLE).toArrow()
    by_length: dict[int, list] = {}
    for unit in sample.column("unit"):
        by_length.setdefault(len(unit.as_buffer()) // 8, []).append(unit)
    models = {}
    for length, units in by_length.items():
        share = total * len(units) / max(1, sample.num_rows)
        cells = int(min(max(1, -(-share // CELL)), MOST_CELLS, max(1, len(units) // 4)))
        matrix = _matrix(units, length)
        centres = centroids(matrix, cells)
        reach = reaches(matrix, centres, threshold)
        models[length] = centres, np.full(cells, farthest(threshold)) if exact else reach
    members = settle(_members(classes, models), "vector-members")
    at_home = F.col("home") == F.col("here")

    def blocks(those: Column) -> Column:
        return F.ceil(F.count(F.when(those, 1)) / BLOCK).cast("int")

    sizes = members.groupBy("cell").agg(
        blocks(at_home).alias("homes"), blocks(~at_home).alias("guests")
    )
    count = F.when(at_home, F.col("homes")).otherwise(F.col("guests"))
    dealt = members.join(settle(sizes, "vector-cells"), "cell").withColumn(
        "block", F.pmod(F.xxhash64("node"), count).cast("int")
    )

    def numbers(upto: str) -> Column:
        return F.when(F.col(upto) > 0, F.sequence(F.lit(0), F.col(upto) - 1)).otherwise(
            F.array().cast("array<int>")
        )

    def meeting(guests: bool, first: Column, second: Column) -> Column:
        return F.struct(F.lit(guests).alias("guests"), first.alias("first"), second.alias("second"))

    own = F.col("block")
    # Those at home meet each other's blocks and the guests' blocks, once each.
    with_homes = F.transform(
        numbers("homes"), lambda x: meeting(False, F.least(own, x), F.greatest(own, x))
    )
    with_guests = F.transform(numbers("guests"), lambda x: meeting(True, own, x))
    as_guest = F.transform(numbers("homes"), lambda x: meeting(True, x, own))
    meetings = F.when(at_home, F.concat(with_homes, with_guests)).otherwise(as_guest)
    met = dealt.withColumn("meeting", F.explode(meetings)).select(
        "cell", "node", "unit", "copies", "home", "others", "here", "block", "meeting.*"
    )

    def group(table: pa.Table) -> pa.Table:
        return _block_links(table, threshold)

    found = settle(
        met.groupBy("cell", "guests", "first", "second").applyInArrow(
            group, "node bigint, root bigint, n_links bigint"
        ),
        "vector-links",
    )
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    component = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = (
        classes.select("node", "smallest", "copies")
        .join(component, "node", "left")
        .join(counts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = settle(
        joined.join(least, "component").select(
            "node",
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        ),
        "vector-components",
    )
    linked = usable.select("key", "node").join(named, "node").select("key", "n_links", "component_id")
    alone = rows.where("node IS NULL").select(
        "key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("key").alias(key),
        "n_links",
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
