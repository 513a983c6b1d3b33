"""Quality rules and robust multivariate outliers of text statistics.

Each text gets statistics of its words, symbols, repeated lines and repeated
words. Plain rules fail texts that are too short or repeat themselves. Of the
others, transformed statistic vectors are held against a minimum covariance
determinant estimate of their language and source: the centre and scatter of
the three quarters of rows that lie closest together, found by concentration
steps. The fewer rows a group has, the more its estimate leans on that of its
language, and this one on that of all rows. A step is two aggregations over all rows - a quantile of distances, then
sums of squares of the rows within it - so a source of any size is spread over
all tasks. A row is rejected if its Mahalanobis distance is past a cutoff.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, map_batches, quoted, runs, settle, text_buffer
from corbel.llm.shingles import BLANK, Words

BATCH = 1 << 20
SYMBOLS = b"#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Share of the rows that an estimate rests on, and its concentration steps.
SUPPORT, STEPS = 0.75, 4
#: The estimate that a group leans on counts as so many of its rows.
LEAN = 20
#: Spread added to each coordinate: ln word length, and ln of symbols, repeated lines and
#: repeated words a hundred words. Below it differences mean nothing, also where most rows are alike.
FLOORS = (0.15, 0.6, 0.7, 0.7)
#: A row of a normal cloud is past the cutoff once in so many.
ODDS = 1_000_000
DIMENSIONS = len(FLOORS)
#: So many rows say nothing of a group's scatter; its own weight grows from 0 with those beyond.
TOO_FEW = 2 * DIMENSIONS
_AXES = range(DIMENSIONS)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Words are runs of anything but ASCII white space; ``word_chars`` are their
    code points; ``n_dup_lines`` are lines with a word that equal an earlier one;
    ``n_repeat_words`` are words in 5-word windows that the text has twice or more.
    Null and empty texts have none of anything. Same-named columns are replaced.
    """
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def repeated_lines(text: bytes) -> int:
        lines = [x for x in text.split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_buffer(column(batch, text))
        parts: list[list[np.ndarray]] = [[] for _ in STATISTICS]
        for first, last in runs(offsets, BATCH):
            span = offsets[first : last + 1] - offsets[first]
            own = data[offsets[first] : offsets[last]]
            words = Words(own, span, lower=False)
            lines = [repeated_lines(own[a:b].tobytes()) for a, b in zip(span[:-1], span[1:])]
            begins = (own & 0xC0) != 0x80  # first bytes of code points
            for part, value in zip(
                parts,
                (
                    words.counts,
                    sums(begins & ~BLANK[own], span),
                    sums(symbol[own], span),
                    np.array(lines, np.int64),
                    words.repeated(),
                ),
            ):
                part.append(value)
        return [pa.array(np.concatenate(x), pa.int64()) for x in parts]

    return map_batches(df, [T.StructField(x, T.LongType()) for x in STATISTICS], compute)


def base_failed() -> Column:
    """Fewer than ten words, or more than a fifth of them in repeated windows."""
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def vector() -> list[Column]:
    """The transformed statistics that distances are taken of."""
    words = F.col("n_words") + 1

    def rate(name: str) -> Column:
        return F.log1p(100 * F.col(name) / words)

    return [
        F.log((F.col("word_chars") + 1) / words),
        rate("n_symbols"),
        rate("n_dup_lines"),
        rate("n_repeat_words"),
    ]


def _cdf(x: float, dimensions: int) -> float:
    """Chi-square distribution function for an even number of dimensions."""
    terms = ((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))
    return 1 - math.exp(-x / 2) * sum(terms)


def _quantile(p: float, dimensions: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _cdf(middle, dimensions) < p else (low, middle)
    return high


def distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``centre`` under ``inverse``."""
    apart = [F.col("x")[i] - F.col("centre")[i] for i in _AXES]
    terms = [apart[i] * apart[j] * F.col("inverse")[DIMENSIONS * i + j] for i, j in product(_AXES, _AXES)]
    return sum(terms[1:], terms[0])


def group_name(groups: list[str]) -> Column:
    """One name for the values of the group columns; null is a value of its own."""
    return F.concat_ws(
        "\x1f", *[F.coalesce(F.concat(F.lit("="), quoted(g).cast("string")), F.lit("")) for g in groups]
    )


def level_names(groups: list[str]) -> list[Column]:
    """Names of all rows' group, that of the first column's value, of the first two, and so on."""
    return [
        F.concat(F.lit(f"{n}\x1e"), group_name(groups[:n]) if n else F.lit(""))
        for n in range(len(groups) + 1)
    ]


def estimate(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Centre and inverse scatter (``group``, ``level``, ``n``, ``centre``, ``inverse``) of each group.

    ``stats`` should be stored and narrow: it is read in every step. There is a
    group of all rows (level 0), one for each value of the first of ``groups``, of
    the first two, and so on. Each is drawn towards the group around it, which
    counts as ``LEAN`` rows. Rows that the plain rules fail take no part.
    """
    names = level_names(groups)
    around = [F.lit(None).cast("string"), *names]
    of = [
        F.struct(F.lit(n).alias("level"), name.alias("group"), around[n].alias("around"))
        for n, name in enumerate(names)
    ]
    good = stats.where(~base_failed()).select(
        F.explode(F.array(*of)).alias("of"), F.array(*vector()).alias("x")
    )
    rows = settle(good.select("of.*", "x"), "vectors")
    families = settle(
        rows.groupBy("group").agg(F.first("level").alias("level"), F.first("around").alias("around")),
        "families",
    )
    rows = rows.select("group", "x")
    medians = rows.groupBy("group").agg(
        F.count("*").alias("n"),
        F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 1000) for i in _AXES]).alias("centre"),
    )
    medians = settle(medians, "medians")
    spreads = (
        rows.join(medians, "group")
        .groupBy("group")
        .agg(
            F.first("n").alias("n"),
            F.first("centre").alias("centre"),
            F.array(
                *[
                    F.percentile_approx(F.abs(F.col("x")[i] - F.col("centre")[i]), 0.5, 1000)
                    for i in _AXES
                ]
            ).alias("mad"),
        )
    )
    # A median deviation of a normal cloud is 0.6745 of its standard deviation.
    variances = [F.pow(F.col("mad")[i] / 0.6745, 2) + FLOORS[i] ** 2 for i in _AXES]
    diagonal = [1 / variances[i] if i == j else F.lit(0.0) for i, j in product(_AXES, _AXES)]
    estimates = settle(
        spreads.select("group", "n", "centre", F.array(*diagonal).alias("inverse")), "estimates"
    )
    for _ in range(STEPS):
        estimates = settle(_concentrated(rows, estimates), "estimates")
    return _leaning(settle(estimates.join(families, "group"), "estimates"), len(groups))


def _leaning(estimates: DataFrame, levels: int) -> DataFrame:
    """Each estimate drawn towards that of the group around it, from the outermost on.

    Centre and scatter are those of the group's rows, beyond ``TOO_FEW``, and ``LEAN``
    rows of the group around it taken together: without a step at any number of rows.
    """

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, inverses = [], []
            for row in batch.to_pylist():
                rows = max(0, row["n"] - TOO_FEW)
                share = rows / (rows + LEAN)
                own, other = np.array(row["centre"]), np.array(row["outer_centre"])
                scatters = [
                    np.linalg.inv(np.array(row[x]).reshape(DIMENSIONS, DIMENSIONS))
                    for x in ("inverse", "outer_inverse")
                ]
                between = share * (1 - share) * np.outer(own - other, own - other)
                scatter = share * scatters[0] + (1 - share) * scatters[1] + between
                centres.append((share * own + (1 - share) * other).tolist())
                inverses.append(np.linalg.inv(scatter).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, x) for x in ("group", "level", "n")),
                 pa.array(centres, pa.list_(pa.float64())), pa.array(inverses, pa.list_(pa.float64()))],
                names=made,
            )

    made = ["group", "level", "n", "centre", "inverse"]
    schema = "group string, level int, n bigint, centre array<double>, inverse array<double>"
    done = [estimates.where("level = 0").select(*made)]
    for level in range(1, levels + 1):
        outer = done[-1].select(
            F.col("group").alias("around"),
            F.col("centre").alias("outer_centre"),
            F.col("inverse").alias("outer_inverse"),
        )
        joined = estimates.where(F.col("level") == level).join(outer, "around")
        done.append(settle(joined.mapInArrow(lean, schema), "estimates"))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: estimates from the rows closest to the estimates before."""
    apart = rows.join(estimates, "group").select("group", "n", "x", distance().alias("d"))
    limits = settle(
        apart.groupBy("group").agg(F.percentile_approx("d", SUPPORT, 1000).alias("limit")), "limits"
    )
    squares = [(i, j) for i, j in product(_AXES, _AXES)]
    sums = (
        apart.join(limits, "group")
        .where("d <= limit")
        .groupBy("group")
        .agg(
            F.first("n").alias("n"),
            F.count("*").alias("near"),
            F.array(*[F.sum(F.col("x")[i]) for i in _AXES]).alias("sums"),
            F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in squares]).alias("squares"),
        )
    )
    # What the closest three quarters of a normal cloud show of its scatter.
    factor = SUPPORT / _cdf(_quantile(SUPPORT, DIMENSIONS), DIMENSIONS + 2)

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, inverses = [], []
            for row in batch.to_pylist():
                centre = np.array(row["sums"]) / row["near"]
                second = np.array(row["squares"]).reshape(DIMENSIONS, DIMENSIONS) / row["near"]
                scatter = factor * (second - np.outer(centre, centre)) + np.diag(FLOORS) ** 2
                centres.append(centre.tolist())
                inverses.append(np.linalg.inv(scatter).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "group"), column(batch, "n"), pa.array(centres, pa.list_(pa.float64())),
                 pa.array(inverses, pa.list_(pa.float64()))],
                names=["group", "n", "centre", "inverse"],
            )

    schema = "group string, n bigint, centre array<double>, inverse array<double>"
    return sums.mapInArrow(invert, schema)


def judge(stats: DataFrame, estimates: DataFrame, groups: list[str]) -> DataFrame:
    """Add ``base_failed``, ``distance`` and ``kept`` to rows with statistics.

    ``kept`` is false if a plain rule fails the row or its squared distance from
    its group's centre is past the cutoff. A group that has no estimate is held
    against that around it. Without any estimate only the plain rules speak.
    """
    cutoff = _quantile(1 - 1 / ODDS, DIMENSIONS)
    made = {"base_failed", "distance", "kept"}
    names = [c for c in stats.columns if c.lower() not in made]
    joined = stats.select(
        *[quoted(c) for c in names],
        *[name.alias(f"outlier_group_{n}") for n, name in enumerate(level_names(groups))],
        F.lit(None).cast("array<double>").alias("centre"),
        F.lit(None).cast("array<double>").alias("inverse"),
    )
    for n in range(len(groups), -1, -1):
        wanted = f"outlier_group_{n}"
        own = estimates.where(F.col("level") == n).select(
            F.col("group").alias(wanted),
            F.col("centre").alias("found_centre"),
            F.col("inverse").alias("found_inverse"),
        )
        # Only rows without an estimate look for one further out.
        joined = (
            joined.withColumn(wanted, F.when(F.col("centre").isNull(), F.col(wanted)))
            .join(own if n else F.broadcast(own), wanted, "left")
            .withColumn("centre", F.coalesce("centre", "found_centre"))
            .withColumn("inverse", F.coalesce("inverse", "found_inverse"))
            .drop("found_centre", "found_inverse", wanted)
        )
    joined = joined.withColumn("x", F.array(*vector()))
    far = F.coalesce(distance() > cutoff, F.lit(False))
    return joined.select(
        *[quoted(c) for c in names],
        base_failed().alias("base_failed"),
        distance().alias("distance"),
        (~base_failed() & ~far).alias("kept"),
    )
