"""Shards of nearly equal bytes, cut by a histogram sort.

Rows are ordered by a hash of their text and then by their key: shards are
random samples, and equal texts lie together. Where to cut is found without
sorting: each round counts the exact bytes below candidate boundaries in one
aggregation over all partitions, and looks closer only where a cut is not yet
within its tolerance, first by the bits of the hash and then, inside one text
too common for that, by the key. Then the rows are exchanged once. Only
built-in functions are used.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corbel.llm.common import quoted, settle

#: Leading bits of the hash (and then of the key) that successive rounds look at.
ROUNDS = (12, 24, 36, 48, 64)


@dataclass(frozen=True, order=True)
class Cut:
    """Rows below this hash, or of this hash and below this key, lie before the cut."""

    hash: int
    key: int = -(1 << 63)


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text (none if null) and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


class _Splitters:
    """Cuts that come nearest to targets, refined until each is within its tolerance.

    ``known`` are candidate cuts with the exact bytes below them, in order.
    """

    def __init__(self, targets: list[float], tolerances: list[float], total: int):
        self.targets, self.tolerances = targets, tolerances
        self.cuts, self.below = [Cut(-(1 << 63)), Cut((1 << 63) - 1, (1 << 63) - 1)], [0, total]

    def add(self, found: list[tuple[Cut, int]]) -> None:
        merged = dict(zip(self.cuts, self.below)) | dict(found)
        self.cuts = sorted(merged)
        self.below = [merged[c] for c in self.cuts]

    def nearest(self, i: int) -> int:
        at = bisect_left(self.below, self.targets[i])
        near = [j for j in (at - 1, at) if 0 <= j < len(self.cuts)]
        return min(near, key=lambda j: abs(self.below[j] - self.targets[i]))

    def open(self) -> list[Cut]:
        """Beginnings of the gaps in which a cut is still sought."""
        gaps = set()
        for i, target in enumerate(self.targets):
            if abs(self.below[self.nearest(i)] - target) > self.tolerances[i]:
                gaps.add(self.cuts[bisect_left(self.below, target) - 1])
        return sorted(gaps)

    def bytes_below(self, cut: Cut) -> int:
        return self.below[self.cuts.index(cut)]

    def chosen(self) -> list[Cut]:
        return [self.cuts[self.nearest(i)] for i in range(len(self.targets))]


def _refine(rows: DataFrame, splitters: _Splitters) -> None:
    """Count bytes below ever closer candidates (``rows``: ``hash``, ``key``, ``size``)."""
    shown = 0
    for bits in ROUNDS:
        gaps = splitters.open()
        if not gaps:
            return
        inside = rows
        if shown:
            prefixes = [c.hash >> (64 - shown) for c in gaps]
            inside = rows.where(F.shiftright("hash", 64 - shown).isin(prefixes))
        # At most 2**12 (or 2**16) sums for each gap come to the driver, and gaps are fewer than cuts.
        prefix = F.shiftright("hash", 64 - bits)
        sums = inside.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("n")).collect()
        found = []
        for gap in gaps:
            at = splitters.bytes_below(gap)
            own = [
                (r.prefix, r.n)
                for r in sums
                if not shown or r.prefix >> (bits - shown) == gap.hash >> (64 - shown)
            ]
            for value, n in sorted(own):
                found.append((Cut(value << (64 - bits)), at))
                at += n
                end = (value + 1) << (64 - bits)
                if end < 1 << 63:
                    found.append((Cut(end), at))
        splitters.add(found)
        shown = bits
    _refine_by_key(rows, splitters)


def _refine_by_key(rows: DataFrame, splitters: _Splitters) -> None:
    """Divide single texts that are too common for a cut before or after all their copies."""
    shown = 0
    hashes = sorted({c.hash for c in splitters.open()})
    if not hashes:
        return
    common = rows.where(F.col("hash").isin(hashes))
    for bits in ROUNDS:
        gaps = splitters.open()
        if not gaps:
            return
        wanted = None
        for gap in gaps:
            here = F.col("hash") == gap.hash
            if shown:
                here &= F.shiftright("key", 64 - shown) == gap.key >> (64 - shown)
            wanted = here if wanted is None else wanted | here
        prefix = F.shiftright("key", 64 - bits)
        sums = (
            common.where(wanted)
            .groupBy("hash", prefix.alias("prefix"))
            .agg(F.sum("size").alias("n"))
            .collect()
        )
        found = []
        for gap in gaps:
            at = splitters.bytes_below(gap)
            own = [
                (r.prefix, r.n)
                for r in sums
                if r.hash == gap.hash
                and (not shown or r.prefix >> (bits - shown) == gap.key >> (64 - shown))
            ]
            for value, n in sorted(own):
                found.append((Cut(gap.hash, value << (64 - bits)), at))
                at += n
                end = (value + 1) << (64 - bits)
                found.append((Cut(gap.hash, end) if end < 1 << 63 else Cut(gap.hash + 1), at))
        splitters.add(found)
        shown = bits


def shard(
    df: DataFrame,
    shards: int = 8,
    tolerance: float = 0.01,
    parts: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add ``size``, ``shard`` and ``slot`` to all rows.

    Shards hold equal bytes to within ``tolerance`` of one shard at each cut. A
    text's copies share a shard unless they outweigh that; rows equal in text and
    key always do. ``slot`` counts a shard's rows from 0 in the order of the sort.
    Null texts are a text of their own, null keys come first. Columns named like the new
    ones are replaced, all others come back as they are; an empty table gives no row. Each shard is sorted
    in several parts of equal bytes (``parts`` in all, by default two for each
    shuffle partition), so no task holds a whole shard.
    """
    spark = df.sparkSession
    wanted = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-wanted // shards))
    count = shards * each
    made = {"size", "shard", "slot"}
    given = [c for c in df.columns if c.lower() not in made]
    # Under numbers, no name of the caller's can clash with those used here.
    rows = df.select(
        *[quoted(c).alias(f"c{i}") for i, c in enumerate(given)],
        size_of(quoted(text)).alias("size"),
        F.xxhash64(quoted(text)).alias("hash"),
        F.coalesce(quoted(key).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
    )
    narrow = settle(rows.select("hash", "key", "size"), "shard-keys")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    targets = [total * i / count for i in range(1, count)]
    near = [total / shards * tolerance if i % each == 0 else total / count / 2 for i in range(1, count)]
    splitters = _Splitters(targets, near, total)
    _refine(narrow, splitters)
    cuts = splitters.chosen()

    found = _lookup(spark, cuts)
    part = F.col("base") + F.size(
        F.filter(
            "inner",
            lambda c: (c["hash"] < F.col("sort_hash"))
            | ((c["hash"] == F.col("sort_hash")) & (c["key"] <= F.col("sort_key"))),
        )
    )

    def placed(frame: DataFrame) -> DataFrame:
        top = F.shiftright("sort_hash", 64 - ROUNDS[0])
        # 2**12 rows and the cuts: a bound that doesn't depend on the data.
        return frame.join(F.broadcast(found), top == F.col("top"), "left").withColumn("part", part)

    keys = narrow.withColumnsRenamed({"hash": "sort_hash", "key": "sort_key"})
    counts = placed(keys).groupBy("part").agg(F.count("*").alias("n"))
    shard_of = F.expr(f"part div {each}").cast("int")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = settle(
        counts.withColumn("shard", shard_of).select(
            "part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_base")
        ),
        "shard-parts",
    )
    sorted_part = Window.partitionBy("part").orderBy("sort_hash", "sort_key")
    whole = placed(rows.withColumnsRenamed({"hash": "sort_hash", "key": "sort_key"}))
    return (
        whole.withColumn("place", F.row_number().over(sorted_part))
        # A row for each part, and the number of parts is set above.
        .join(F.broadcast(bases), "part")
        .select(
            *[F.col(f"c{i}").alias(c) for i, c in enumerate(given)],
            "size",
            "shard",
            (F.col("part_base") + F.col("place") - 1).cast("bigint").alias("slot"),
        )
    )


def _lookup(spark, cuts: list[Cut]) -> DataFrame:
    """For each value of the hash's leading bits: cuts below it, and cuts inside it."""
    bits = ROUNDS[0]
    tops = range(-(1 << (bits - 1)), 1 << (bits - 1))
    rows = []
    for top in tops:
        first = bisect_right(cuts, Cut(top << (64 - bits)))
        last = bisect_right(cuts, Cut(min((top + 1) << (64 - bits), (1 << 63) - 1)))
        rows.append((top, first, [(c.hash, c.key) for c in cuts[first:last]]))
    return spark.createDataFrame(
        rows, "top bigint, base int, inner array<struct<hash:bigint,key:bigint>>"
    )
