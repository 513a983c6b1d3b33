"""Documents whose word shingles overlap: an exact similarity join by partitioned sets.

Sets whose similarity is 0.75 or more differ in at most H elements, H following
from their sizes. The universe of shingles is dealt by hash into m segments,
m by the size band of the smaller set. Each differing element spoils one
segment, so of the k segments a set has something in, at least k - H are
exactly alike in both sets. A segment's subset is a key; keys are put in one
order for all sets by cost - subsets of shingles common in the corpus last -
and each set needs to show only its first H + 1: two sets that share k - H of
their keys share one among these. A set with too few segments in use shows all its keys and
also its one-deletion neighbourhoods (each subset without one element), which
find subsets that differ in one element; and if even these cannot reach H + 1,
its single shingles. So no pair is missed, and each found pair is verified on
the texts themselves.

Equal sets are one node from the start. Most pairs that share a key only share
a passage; sizes and bit sketches, which bound how far two sets are apart from
below, rule these out within the groups, and only pairs left are verified. They
need not all be: a tree of nearest pairs in each node's most crowded group comes
first, then each node's nearest in all its groups, and all pairs of a group only
where these have not connected what may be connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, map_batches, quoted, runs, settle, text_buffer
from corbel.llm.components import components
from corbel.llm.shingles import U64, Words, mix

#: Two sets link if SIMILAR_OF * intersection >= SIMILAR * union.
SIMILAR, SIMILAR_OF = 75, 100
BATCH = 1 << 20
#: A shingle is common if it is in this share of some run of documents.
COMMON_SHARE, COMMON_LEAST = 0.01, 8
#: Common shingles known to every task, 8 bytes each. They only order keys by cost.
COMMON_KNOWN = 1 << 18
#: A key in more sets of one run than this is grouped there before the shuffle.
CROWD = 32
#: Rounds of comparing: a tree over each node's most crowded group, then in all groups each
#: node with its nearest, then every pair that is left.
TREE, NEAREST, ALL = "tree", "nearest", "all"
ROUNDS = (TREE, NEAREST, NEAREST, ALL)
#: Groups of a node, those of the smallest names, that its members know of.
KNOWN_KEYS = 12
#: Members of a group that are compared at once.
BLOCK = 1 << 10


def band(sizes: np.ndarray) -> np.ndarray:
    """Size band: sizes from 2**b to below 2**(b + 1)."""
    return np.frexp(sizes.astype(np.float64))[1] - 1


def segments(bands: np.ndarray) -> np.ndarray:
    """Segments of a band, about one for each 0.75 to 1.5 elements."""
    return (2 ** (bands + 2)) // 3 + 8


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def keys_of(
    elements: np.ndarray, owner: np.ndarray, scheme: np.ndarray, limit: np.ndarray, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of sets and the sets they are of.

    ``elements`` lie set by set, ``owner`` numbers each one's set from 0;
    ``scheme`` is each set's band and ``limit`` its H. ``common`` is sorted.
    """
    if not len(elements):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    salt = mix(scheme.astype(U64) + U64(0x5851F42D4C957F2D))
    count = segments(scheme).astype(U64)
    spread = mix(elements ^ salt[owner])
    segment = (spread >> U64(32)) * count[owner] >> U64(32)
    order = np.argsort((owner.astype(U64) << U64(40)) | segment, kind="stable")
    owner, segment, spread = owner[order], segment[order], spread[order]
    rare = np.ones(len(elements), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, elements[order]), len(common) - 1)
        rare = common[at] != elements[order]
    fresh = np.empty(len(owner), bool)
    fresh[0] = True
    fresh[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
    starts = np.flatnonzero(fresh)
    used_by, in_segment = owner[starts], segment[starts]
    content = _sums(mix(spread), starts)
    size = np.diff(np.append(starts, len(owner)))
    frequent = ~np.logical_or.reduceat(rare, starts)
    place = mix(salt[used_by] + in_segment)
    key = mix(content ^ place)

    used = np.bincount(used_by, minlength=len(scheme))
    show = limit + 1
    by_cost = np.lexsort((key, frequent, used_by))
    rank = np.arange(len(key)) - np.repeat(np.cumsum(used) - used, used)
    first = by_cost[rank < show[used_by[by_cost]]]
    keys, owners = [key[first]], [used_by[first]]

    short = used < show
    if short.any():
        # One-deletion neighbourhoods of segments with two elements or more.
        group = np.repeat(np.arange(len(starts)), size)
        pick = short[owner] & (size[group] > 1)
        less = content[group[pick]] - mix(spread[pick])
        keys.append(mix(less ^ place[group[pick]]))
        owners.append(owner[pick])
        several = np.bincount(used_by[size > 1], minlength=len(scheme))
        single = (short & (used + several < show))[owner]
        keys.append(mix(spread[single] ^ U64(0x14057B7EF767814F)))
        owners.append(owner[single])
    return np.concatenate(keys), np.concatenate(owners)


def set_keys(
    elements: np.ndarray, bounds: np.ndarray, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets under the schemes in which each may meet a partner."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own = band(np.maximum(sizes, 1))
    union = SIMILAR + SIMILAR_OF
    largest = sizes * SIMILAR_OF // SIMILAR
    # As the smaller set, or one of equal band: partners may be as large as can be.
    limit = (SIMILAR_OF - SIMILAR) * (sizes + largest) // union
    keys, owners = keys_of(elements, owner, own, limit, common)
    # As the larger set of a pair whose smaller one is in the band below.
    below = own - 1
    smallest = -(-sizes * SIMILAR // SIMILAR_OF)
    crosses = (sizes > 0) & (below >= 0) & (smallest < 2 ** np.maximum(own, 0))
    rows = np.flatnonzero(crosses)
    pick = crosses[owner]
    renumber = np.cumsum(crosses) - 1
    limit = (SIMILAR_OF - SIMILAR) * (sizes + 2 ** np.maximum(own, 0) - 1) // union
    more, of = keys_of(elements[pick], renumber[owner[pick]], below[rows], limit[rows], common)
    return np.concatenate([keys, more]), np.concatenate([owners, rows[of]])


def _nodes(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set, equal for equal sets; 0 for the empty set."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(elements ^ U64(0xA0761D6478BD642F)))])
    total = sums[bounds[1:]] - sums[bounds[:-1]]
    sizes = np.diff(bounds).astype(U64)
    return np.where(sizes > 0, mix(total + mix(sizes)), U64(0))


def _sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = text_buffer(texts)
    for first, last in runs(offsets, BATCH):
        span = offsets[first : last + 1]
        words = Words(data[span[0] : span[-1]], span - span[0], lower=True)
        yield words.shingles()


def _common(documents: DataFrame) -> np.ndarray:
    """Shingles that many documents share, the most frequent first, at most ``COMMON_KNOWN``.

    Each run of documents reports only what a hundredth of it shares, so little moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for elements, bounds in _sets(column(batch, "text")):
                found, counts = np.unique(elements, return_counts=True)
                often = counts >= max(COMMON_LEAST, COMMON_SHARE * (len(bounds) - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[often].view(np.int64)), pa.array(counts[often])],
                    names=["shingle", "n"],
                )

    found = documents.select("text").mapInArrow(run, "shingle bigint, n bigint")
    sums = found.groupBy("shingle").agg(F.sum("n").alias("n"))
    known = sums.orderBy(F.desc("n"), "shingle").limit(COMMON_KNOWN).select("shingle").toArrow()
    return np.sort(known.column(0).to_numpy().astype(np.int64).view(U64))


def _entries(documents: DataFrame, common: np.ndarray, parts: int) -> DataFrame:
    """Keys and the nodes that show them, packed by key range.

    A row holds the keys of one run of documents within one range, ``part``: the
    upper 48 bits of each key in ``high`` and ``low``, its node's place in
    ``dictionary`` in ``index``. Keys alike by chance only add a pair to verify.
    A key that a crowd of one run shows is left with one of them, ``crowded``,
    and the crowd goes out as a group of its own, numbered from ``parts`` on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for elements, bounds in _sets(column(batch, "text")):
                rows = _packed(elements, bounds, common, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64())]
                    + [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(1, 6)],
                    names=["part", "high", "low", "index", "crowded", "dictionary"],
                )

    schema = (
        "part bigint, high binary, low binary, index binary, crowded binary, dictionary binary"
    )
    return documents.select("text").mapInArrow(run, schema)


def _packed(elements, bounds, common, parts) -> list[tuple]:
    nodes = _nodes(elements, bounds)
    names, first = np.unique(nodes, return_index=True)
    chosen = np.zeros(len(nodes), bool)
    chosen[first] = True
    keys, owners = set_keys(elements, bounds, common)
    pick = chosen[owners]
    keys, index = keys[pick] >> U64(16), np.searchsorted(names, nodes[owners[pick]])
    order = np.argsort(keys << U64(16) | index.astype(U64), kind="stable")
    keys, index = keys[order], index[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (index[1:] != index[:-1])
    keys, index = keys[fresh], index[fresh]
    leads = np.ones(len(keys), bool)
    leads[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(leads)
    sizes = np.diff(np.append(begins, len(keys)))
    crowded = np.repeat(sizes > CROWD, sizes)

    def row(part: int, keys, index, crowded) -> tuple:
        own, index = np.unique(index, return_inverse=True)
        high, low = (keys >> U64(16)).astype("<u4"), (keys & U64(0xFFFF)).astype("<u2")
        return part, high, low, index.astype("<u2"), crowded, names[own]

    rows = []
    if crowded.any():
        spread = parts + int(mix(keys[crowded][:1])[0] & U64(0xFFFFFFFF))
        rows.append(row(spread, keys[crowded], index[crowded], crowded[crowded]))
    left = ~crowded | leads
    keys, index, crowded = keys[left], index[left], crowded[left]
    # Keys are sorted, so each range of them is a slice.
    edges = np.searchsorted(keys >> U64(16), (np.arange(parts + 1, dtype=U64) << U64(32)) // U64(parts))
    for part in range(parts):
        a, b = edges[part], edges[part + 1]
        if b > a:
            rows.append(row(part, keys[a:b], index[a:b], crowded[a:b]))
    return rows


def _shared(entries: DataFrame) -> DataFrame:
    """``key`` and ``node`` of all keys that more than one node shows.

    Keys of the same nodes are one: it is named by them. Only a key with a crowd
    somewhere keeps its own name, under which its groups meet.
    """

    def group(table: pa.Table) -> pa.Table:
        keys, nodes, crowds = [], [], []
        for batch in table.to_batches():
            for high, low, index, crowded, names in zip(
                *(column(batch, c) for c in ("high", "low", "index", "crowded", "dictionary"))
            ):
                upper = np.frombuffer(high.as_buffer(), "<u4").astype(U64) << U64(16)
                keys.append(upper | np.frombuffer(low.as_buffer(), "<u2"))
                nodes.append(np.frombuffer(names.as_buffer(), U64)[np.frombuffer(index.as_buffer(), "<u2")])
                crowds.append(np.frombuffer(crowded.as_buffer(), bool))
        keys, nodes, crowds = (np.concatenate(x) for x in (keys, nodes, crowds))
        order = np.argsort(keys, kind="stable")
        keys, nodes, crowds = keys[order], nodes[order], crowds[order]
        same = keys[1:] == keys[:-1]
        shared = np.append(False, same) | np.append(same, False) | crowds
        keys, nodes, crowds = keys[shared], nodes[shared], crowds[shared]
        if len(keys):
            begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(begins, len(keys)))
            named = mix(np.add.reduceat(mix(nodes), begins))
            named = np.where(np.logical_or.reduceat(crowds, begins), keys[begins], named)
            _, first = np.unique(named, return_index=True)
            kept = np.zeros(len(begins), bool)
            kept[first] = True
            nodes, keys = nodes[np.repeat(kept, sizes)], np.repeat(named[kept], sizes[kept])
        return pa.table(
            [pa.array(x.view(np.int64)) for x in (keys, nodes)], names=["key", "node"]
        )

    return entries.groupBy("part").applyInArrow(group, "key bigint, node bigint").distinct()


def _alike(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the texts of each row link."""
    linked = []
    for first in range(0, len(a), 64):
        sets = []
        for texts in (a.slice(first, 64), b.slice(first, 64)):
            own = []
            for elements, bounds in _sets(texts):
                own += [elements[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
            sets.append(own)
        for x, y in zip(*sets):
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(both > 0 and SIMILAR_OF * both >= SIMILAR * (len(x) + len(y) - both))
    return np.array(linked, bool)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose texts link."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(_alike(column(batch, "text_a"), column(batch, "text_b")))
            yield batch.select(["a", "b"]).filter(keep)

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def group_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of all rows.

    ``component_id`` is the smallest key that links reach. Rows without words have
    no shingles and link with nothing; a row whose key is null takes part, but
    names a component only if all its rows' keys are null. Repeated rows and equal
    texts are in one component.
    """
    spark = df.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = df.select(quoted(key).cast("bigint").alias("key"), quoted(text).alias("text"))

    documents = settle(_described(named).drop("text"), "jaccard-documents")
    shared = settle(_shared(_entries(named, _common(named), parts)), "jaccard-shared")
    found = settle(_links(named, documents, shared, parts), "jaccard-links")
    component = components(found).select("node", "component")
    nodes = documents.groupBy("node").agg(F.min("key").alias("smallest"))
    joined = nodes.join(component, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    classes = joined.join(least, "component").select("node", "component_id")
    classes = settle(classes, "jaccard-classes")
    # The rows without shingles have one node but nothing in common.
    return (
        documents.where("n_shingles > 0")
        .join(classes, "node")
        .select(F.col("key").alias(key), "n_shingles", "component_id")
        .unionByName(
            documents.where("n_shingles = 0").select(
                F.col("key").alias(key), "n_shingles", F.col("key").alias("component_id")
            )
        )
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly one row of each group of near copies, with all its columns, and every row in none.

    Rows are told apart by a number written beforehand, so keys may be null, repeat, or stand
    on different texts. The row with the smallest key stays (null after all others), the
    first written one of equal keys. Rows without words are in no group and stay; an empty
    table gives no row.
    """
    names = {name.lower() for name in df.columns}
    number = next(x for x in ("row", *(f"row_{i}" for i in range(len(names) + 1))) if x not in names)
    rows = settle(df.withColumn(number, F.monotonically_increasing_id()), "jaccard-rows")
    groups = group_documents(rows, number, text).select(F.col(number).alias("own"), "component_id")
    keys = rows.select(F.col(number).alias("own"), quoted(key).alias("key"))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "own")).alias("first")
    kept = groups.join(keys, "own").groupBy("component_id").agg(first).select(F.col("first.own").alias("own"))
    return rows.join(kept, F.col(number) == F.col("own"), "left_semi").drop(number)


def sketch(elements: np.ndarray, size: int) -> bytes:
    """Parities of how many elements fall into each of some bins, a power of two by size band.

    Each element in one of two sets alone changes one bit at most, so sets never
    differ in fewer elements than their sketches do in bits. Folding a sketch in
    half gives the one with half as many bins.
    """
    bins = max(64, 1 << (max(size, 1).bit_length() + 1))
    place = mix(elements ^ U64(0xE7037ED1A0B428DB)) & U64(bins - 1)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=bins) & 1).tobytes()


def _described(named: DataFrame) -> DataFrame:
    """Add ``n_shingles``, ``node`` and ``sketch``."""

    def describe(batch: pa.RecordBatch) -> list[pa.Array]:
        sizes, nodes, sketches = [], [], []
        for elements, bounds in _sets(column(batch, "text")):
            sizes.append(np.diff(bounds))
            nodes.append(_nodes(elements, bounds).view(np.int64))
            sketches += [
                sketch(elements[a:b], b - a) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ]
        return [
            pa.array(np.concatenate(sizes)),
            pa.array(np.concatenate(nodes)),
            pa.array(sketches, pa.binary()),
        ]

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
    ]
    return map_batches(named, fields, describe)


def _folded(sketches: np.ndarray) -> np.ndarray:
    half = sketches.shape[1] // 2
    return sketches[:, :half] ^ sketches[:, half:]


def possible(sizes: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of sets may link, by their sizes and sketches, and how many bits are apart."""
    count = len(sizes)
    table = np.zeros((count, count), bool)
    bits_apart = np.zeros((count, count), np.int64)
    lengths = np.array([len(x) for x in sketches])
    allowed = (SIMILAR_OF - SIMILAR) * (sizes[:, None] + sizes[None, :]) // (SIMILAR + SIMILAR_OF)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        own = np.frombuffer(b"".join(sketches[i] for i in rows), U64).reshape(len(rows), -1)
        larger = np.flatnonzero(lengths == 2 * length)
        other, both = own, rows
        if len(larger):
            wide = np.frombuffer(b"".join(sketches[i] for i in larger), np.uint8)
            wide = np.ascontiguousarray(_folded(wide.reshape(len(larger), -1))).view(U64)
            other, both = np.concatenate([own, wide]), np.concatenate([rows, larger])
        step = max(1, (1 << 20) // max(1, other.size))
        for first in range(0, len(rows), step):
            part = rows[first : first + step]
            bits = np.bitwise_count(own[first : first + step, None, :] ^ other[None, :, :])
            apart = bits.sum(axis=2, dtype=np.int64)
            table[np.ix_(part, both)] = apart <= allowed[np.ix_(part, both)]
            bits_apart[np.ix_(part, both)] = apart
    table |= table.T
    bits_apart = np.maximum(bits_apart, bits_apart.T)
    small = np.minimum(sizes[:, None], sizes[None, :])
    large = np.maximum(sizes[:, None], sizes[None, :])
    table &= SIMILAR_OF * small >= SIMILAR * large
    np.fill_diagonal(table, False)
    return table, bits_apart


def tree(table: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``table`` that connect all it connects, the least ``apart`` first."""
    never = 1 << 40
    length = np.where(table, apart, never)
    near, via = np.full(len(table), never), np.zeros(len(table), np.int64)
    inside = np.zeros(len(table), bool)
    links = []
    for _ in range(len(table)):
        node = int(np.argmin(np.where(inside, never + 1, near)))
        if near[node] < never:
            links.append((via[node], node))
        inside[node] = True
        closer = (length[node] < near) & ~inside
        near[closer], via[closer] = length[node][closer], node
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def met_before(key: int, keys: list[np.ndarray]) -> np.ndarray:
    """Which pairs of members of a group share a smaller name of a group among ``keys`` (of each, in order)."""
    count = len(keys)
    smaller = [x[: np.searchsorted(x, key)] for x in keys]
    owner = np.repeat(np.arange(count), [len(x) for x in smaller])
    names, place, often = np.unique(np.concatenate(smaller), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(often > 1)
    if not len(shared):
        return np.zeros((count, count), bool)
    number = np.full(len(names), -1, np.int64)
    number[shared] = np.arange(len(shared))
    column_of = number[place]
    together = np.zeros((count, count), bool)
    for first in range(0, len(shared), BLOCK):
        held = np.zeros((count, min(BLOCK, len(shared) - first)), np.float32)
        some = (column_of >= first) & (column_of < first + BLOCK)
        held[owner[some], column_of[some] - first] = 1
        together |= held @ held.T > 0
    return together


def _candidates(
    members: DataFrame, nodes: DataFrame, parts: int, which: str
) -> DataFrame:
    """Pairs ``a`` < ``b`` of members of a group (``key``) that may link and are not connected yet.

    ``members`` have ``key``, ``node``, ``component``, and ``nodes`` ``n_shingles`` and
    ``sketch`` of each ``node``. A large group is dealt into blocks and each two of these
    meet. A pair is passed over in a group if both are known to share one of a smaller name,
    so nearly all come out of one group, and every one out of one at least. ``apart`` is a bound on how far the pair's sets are
    apart. ``which`` pairs are given: of a ``tree`` of near ones, each member with its
    ``nearest``, or ``all``.
    """
    smallest = F.slice(F.sort_array(F.collect_list("key")), 1, KNOWN_KEYS)
    own_keys = members.groupBy("node").agg(smallest.alias("keys"))
    nodes = nodes.join(own_keys, "node")
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = (
        members.join(sizes, "key")
        .join(nodes, "node")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
            F.when(F.col("blocks") == 1, -1).when(F.col("block") == F.col("other"), -1)
            .otherwise(F.col("block")).alias("side"),
            "key", "keys", "node", "component", "n_shingles", "sketch",
        )
    )

    def cell(rows: pa.Table) -> np.ndarray:
        node, component, size, side = (
            rows.column(c).to_numpy() for c in ("node", "component", "n_shingles", "side")
        )
        if component.min() == component.max():
            return np.zeros((0, 3), np.int64)
        table, apart = possible(size, rows.column("sketch").to_pylist())
        table &= component[:, None] != component[None, :]
        if (side >= 0).any():
            table &= side[:, None] != side[None, :]
        if which != TREE and table.any():  # there each node is in one group
            keys = rows.column("keys").combine_chunks()
            keys = [keys[i].values.to_numpy() for i in range(len(keys))]
            table &= ~met_before(rows.column("key")[0].as_py(), keys)
        if which == ALL:
            i, j = np.nonzero(np.triu(table))
        elif which == TREE:
            i, j = tree(table, apart)
        else:
            i = np.flatnonzero(table.any(axis=1))
            j = np.argmin(np.where(table[i], apart[i], 1 << 40), axis=1)
        pair = np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), apart[i, j]
        return np.stack(pair, axis=1)

    def group(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("cell")
        cells = table.column("cell").to_numpy()
        edges = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        pairs = [
            cell(table.slice(first, last - first))
            for first, last in zip(edges, np.append(edges[1:], len(cells)))
        ]
        pairs = np.unique(np.concatenate(pairs), axis=0)
        return pa.table([pa.array(pairs[:, i]) for i in range(3)], names=["a", "b", "apart"])

    dealt = met.groupBy(F.pmod("cell", F.lit(4 * parts)).alias("part"))
    return dealt.applyInArrow(group, "a bigint, b bigint, apart bigint").distinct()


def _crowded(members: DataFrame) -> DataFrame:
    """Each node in its most crowded group only."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "key")).alias("most")
    return (
        members.join(sizes, "key")
        .groupBy("node", "component")
        .agg(most)
        .select("most.key", "node", "component")
    )


def _nearest(found: DataFrame) -> DataFrame:
    """Of the pairs of each node the one least apart."""
    pair = F.struct("apart", "a", "b")
    ends = [found.groupBy(F.col(x).alias("node")).agg(F.min(pair).alias("pair")) for x in "ab"]
    least = ends[0].unionByName(ends[1]).groupBy("node").agg(F.min("pair").alias("pair"))
    return least.select("pair.a", "pair.b").distinct()


def _links(named: DataFrame, documents: DataFrame, shared: DataFrame, parts: int) -> DataFrame:
    """Links between nodes, enough to connect all that any links connect."""
    taking_part = shared.select("node").distinct()
    nodes = settle(
        documents.select("node", "n_shingles", "sketch")
        .join(taking_part, "node", "left_semi")
        .dropDuplicates(["node"]),
        "jaccard-nodes",
    )
    members = shared.withColumn("component", F.col("node"))
    tried = links = None
    for which in ROUNDS:
        own = _crowded(members) if which == TREE else members
        found = settle(_candidates(own, nodes, parts, which), "jaccard-candidates")
        pairs = _nearest(found) if which == NEAREST else found.select("a", "b")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = settle(pairs, "jaccard-pairs")
        linked = settle(_verified(pairs, _texts(named, documents, pairs)), "jaccard-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = linked if links is None else links.unionByName(linked)
        if which != ALL:
            if which == NEAREST:
                # A node that may link with any other has been given with one.
                ends = found.select(F.col("a").alias("node")).unionByName(
                    found.select(F.col("b").alias("node"))
                )
                members = members.join(ends.distinct(), "node", "left_semi")
            members = settle(_open(members, components(links)), "jaccard-members")
    return links


def _open(members: DataFrame, component: DataFrame) -> DataFrame:
    """Members, with their components, of the groups that are not connected yet."""
    placed = settle(
        members.drop("component")
        .join(component, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "jaccard-placed",
    )
    torn = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key")
    )
    return placed.join(torn, "key", "left_semi")


def _texts(named: DataFrame, documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """A text of each node of ``pairs``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    holders = documents.join(wanted, "node").groupBy("node").agg(F.min("key").alias("holder"))
    holding = holders.select("holder").distinct()
    # A key may be null or on several rows: the node is taken from the text again.
    held = named.join(holding, F.col("key").eqNullSafe(F.col("holder")), "left_semi")
    return settle(
        _described(held).join(wanted, "node").dropDuplicates(["node"]).select("node", "text"),
        "jaccard-texts",
    )
