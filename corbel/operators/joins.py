"""Joins that stay whole and splittable when one key holds many rows.

Plain inner joins are ``left.join(right, ...)``: adaptive execution splits a hot
partition of either side. It can split only the preserved side of an outer join
and neither side of a full one, and only the left side of a semi or anti join.
So outer joins are inner joins here, of sides that were given a row of nulls for
each key that only the other side has, and existence is a join with distinct
keys. No function hints a broadcast; Spark decides by the measured size. The splitting relies on
``spark.sql.adaptive.skewJoin.enabled`` and, where it costs another shuffle, on
``spark.sql.adaptive.forceOptimizeSkewedJoin`` (:data:`corbel.session.SETTINGS`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.paths import column_at, quoted, require_distinct

# Spark's own names of the join types.
KINDS = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "outer": "full",
    "full": "full",
    "full_outer": "full",
}

On = Mapping[str, str] | Sequence[str]


def _kind(how: str) -> str:
    if how not in KINDS:
        raise ValueError(f"unknown join type {how!r}")
    return KINDS[how]


def _pairs(on: On) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(name, name) for name in on]


def _col(df: DataFrame, name: str) -> Column:
    """Column of a frame by its literal name."""
    return df[quoted(name)]


def _keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct keys, one row each: a hot key shrinks before it is shuffled."""
    return df.select(
        *[column_at([name]).alias(f"__key{n}") for n, name in enumerate(names)]
    ).distinct()


def _existence(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str
) -> DataFrame:
    keys = _keys(right, [theirs for _, theirs in pairs])
    matches = [_col(left, mine) == keys[f"__key{n}"] for n, (mine, _) in enumerate(pairs)]
    return left.join(keys, matches, how)


def semi_join(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Rows of ``left`` with at least one partner in ``right``."""
    return _existence(left, right, _pairs(on), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Rows of ``left`` without a partner; rows with a null key have none."""
    return _existence(left, right, _pairs(on), "left_anti")


# Rows with a null key have no partner but the other side's rows of nulls, one for each of
# these marks, over which they are dealt out.
SPREAD = 64
_MARK = "__mark"


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(item.dataType) for item in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _marks(df: DataFrame, sign: int) -> Column:
    """One of :data:`SPREAD` marks, the same for a row whenever it is computed."""
    hashed = [column_at([item.name]) for item in df.schema if _hashable(item.dataType)]
    return F.lit(sign) * (F.pmod(F.xxhash64(F.lit(0), *hashed), F.lit(SPREAD)) + 1)


def _marked(
    df: DataFrame, keys: Sequence[Column], partnerless: Column, side: str, sign: int, keep: bool
) -> DataFrame:
    """Rows with keys ``__<side>0``, ... and a mark; a partnerless row has a mark and no keys."""
    if not keep:
        df = df.filter(~partnerless)
    return df.select(
        "*",
        F.when(partnerless, _marks(df, sign)).otherwise(F.lit(0)).cast("bigint").alias(f"{_MARK}_{side}"),
        *[F.when(~partnerless, key).alias(f"__{side}{n}") for n, key in enumerate(keys)],
    )


def _nulls_for_marks(df: DataFrame, side: str, sign: int) -> DataFrame:
    """A row of nulls for each mark that partnerless rows of the other side have."""
    marks = df.sparkSession.range(1, SPREAD + 1).select((F.col("id") * sign).alias(f"{_MARK}_{side}"))
    return df.unionByName(marks, allowMissingColumns=True)


def _met(lefts: DataFrame, rights: DataFrame, n_keys: int, columns: Sequence[str]) -> DataFrame:
    """Marked sides joined: by their keys, or by mark."""
    same = [F.col(f"{_MARK}_l") == F.col(f"{_MARK}_r")]
    same += [F.col(f"__l{n}").eqNullSafe(F.col(f"__r{n}")) for n in range(n_keys)]
    return lefts.join(rights, same).select(*[column_at([name]) for name in columns])


def outer_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    """Outer join (or inner) that can be split whichever side holds a hot key.

    ``on`` maps left key columns to right ones. The two frames must not share
    column names. Distinct keys of both sides are met first, reduced in each task:
    one bit tells which sides have a key. A side then gets a row of nulls for every key that
    only the other has, and the sides are joined as inner ones, so each is shuffled once,
    and read once beside its keys. Rows with a null key meet rows of nulls
    of their own, in :data:`SPREAD` groups.
    """
    require_distinct([*left.columns, *right.columns])
    how = _kind(how)
    if how == "inner":
        return left.join(right, [_col(left, mine) == _col(right, theirs) for mine, theirs in on.items()])
    sides = {"l": (left, list(on), 1), "r": (right, list(on.values()), -1)}
    kept = {"l": how in ("left", "full"), "r": how in ("right", "full")}
    known, marked = [], {}
    for bit, (side, (df, names, sign)) in enumerate(sides.items(), start=1):
        keys = [column_at([name]) for name in names]
        absent = reduce(or_, (key.isNull() for key in keys))
        numbered = [key.alias(f"__key{n}") for n, key in enumerate(keys)]
        known.append(df.filter(~absent).select(*numbered, F.lit(bit).alias("__side")))
        marked[side] = _marked(df, keys, absent, side, sign, kept[side])
    names = [f"__key{n}" for n in range(len(on))]
    # One column for both sides' needs: the two uses are the same aggregate, computed once.
    sides_of = known[0].union(known[1]).groupBy(*names).agg(F.bit_or("__side").alias("__sides"))
    for side, other, bit, sign in (("l", "r", 2, -1), ("r", "l", 1, 1)):
        if kept[other]:
            lone = sides_of.filter(F.col("__sides") == bit).select(
                F.lit(0).cast("bigint").alias(f"{_MARK}_{side}"),
                *[F.col(name).alias(f"__{side}{n}") for n, name in enumerate(names)],
            )
            filled = marked[side].unionByName(lone, allowMissingColumns=True)
            marked[side] = _nulls_for_marks(filled, side, sign)
    return _met(marked["l"], marked["r"], len(on), [*left.columns, *right.columns])


def using_join(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Inner join that keeps the left key name and emits the key once, first."""
    renamed = right.withColumnsRenamed({theirs: mine for mine, theirs in on.items()})
    return left.join(renamed, list(on))


def suffixed_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], suffix: str = "_right"
) -> DataFrame:
    """Inner join keeping all columns; shared names of the right get a suffix."""
    shared = {name: name + suffix for name in right.columns if name in left.columns}
    require_distinct([*left.columns, *[shared.get(name, name) for name in right.columns]])
    renamed = right.withColumnsRenamed(shared)
    return left.join(
        renamed,
        [
            _col(left, mine) == _col(renamed, shared.get(theirs, theirs))
            for mine, theirs in on.items()
        ],
    )


def _packed(df: DataFrame, name: str, extra: Mapping[str, str]) -> DataFrame:
    """The whole row as one struct column, beside copies of some columns."""
    whole = F.struct(*[column_at([column]) for column in df.columns])
    return df.select(
        whole.alias(name), *[column_at([column]).alias(alias) for alias, column in extra.items()]
    )


def pair_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner"
) -> DataFrame:
    """Join into two struct columns ``_1`` and ``_2``, one per side.

    Rows are packed before the join, so on an outer join an absent side is null
    itself and not a struct of nulls.
    """
    mine = _packed(left, "_1", {f"__left{n}": key for n, key in enumerate(on)})
    theirs = _packed(right, "_2", {f"__right{n}": key for n, key in enumerate(on.values())})
    keys = {f"__left{n}": f"__right{n}" for n in range(len(on))}
    return outer_join(mine, theirs, keys, how).select("_1", "_2")


def membership_join(
    left: DataFrame,
    right: DataFrame,
    array: str,
    member: str,
    how: str = "inner",
    left_key: Sequence[str] = (),
) -> DataFrame:
    """Join rows whose ``array`` contains the ``member`` of the other side.

    As a condition on the pair this would run as a nested loop over both tables.
    Instead each distinct element becomes a row and meets its member by an
    equality join. For the outer forms keys alone meet first: a row of the left
    gets back an array of those of its elements that are members, a row of the
    right whether it is an element. Rows without any then meet a row of nulls in the
    same join. For the left ones ``left_key`` must name columns that identify a row.
    """
    require_distinct([*left.columns, *right.columns])
    how = _kind(how)
    if how in ("left", "full") and not left_key:
        raise ValueError("the rows left over on the left need a left_key")
    elements = F.explode(F.array_distinct(column_at([array])))
    if how == "inner":
        spread = left.withColumn("__member", elements)
        return spread.join(right, spread["__member"] == _col(right, member)).drop("__member")
    columns = [*left.columns, *right.columns]
    if how in ("left", "full"):
        lefts = _nulls_for_marks(_with_members(left, right, array, member, left_key), "l", -1)
    else:
        spread = left.withColumn("__element", elements)
        element = F.col("__element")
        lefts = _nulls_for_marks(_marked(spread, [element], element.isNull(), "l", 1, False), "l", -1)
    if how in ("right", "full"):
        met = left.select(elements.alias("__element")).distinct().filter("__element IS NOT NULL")
        found = right.join(met, _col(right, member) == met["__element"], "left")
        alone = F.col("__element").isNull()
    else:
        found, alone = right, column_at([member]).isNull()
    marked = _marked(found, [column_at([member])], alone, "r", -1, how in ("right", "full"))
    return _met(lefts, _nulls_for_marks(marked, "r", 1), 1, columns)


def _with_members(
    left: DataFrame, right: DataFrame, array: str, member: str, left_key: Sequence[str]
) -> DataFrame:
    """Left rows by each element that is a member, marked where there is none."""
    # As a struct, which is never null, nulls in the key are equal and one shuffle serves both.
    key = F.struct(*[column_at([name]).alias(f"key{n}") for n, name in enumerate(left_key)])
    narrow = left.select(
        key.alias("__key"), F.explode(F.array_distinct(column_at([array]))).alias("__element")
    )
    members = right.select(column_at([member]).alias("__member")).distinct()
    # As many as the row's array has; the rows themselves don't take part.
    found = (
        narrow.join(members, F.col("__element") == F.col("__member"))
        .groupBy("__key")
        .agg(F.collect_list("__element").alias("__found"))
    )
    joined = left.withColumn("__key", key).join(found, "__key", "left").drop("__key")
    element = F.explode_outer("__found")
    spread = joined.withColumn("__element", element).drop("__found")
    return _marked(spread, [F.col("__element")], F.col("__element").isNull(), "l", 1, True)


def membership_pairs(
    left: DataFrame,
    right: DataFrame,
    array: str,
    member: str,
    how: str = "inner",
    left_key: Sequence[str] = (),
) -> DataFrame:
    """:func:`membership_join` into struct columns ``_1`` and ``_2``."""
    keys = {f"__id{n}": key for n, key in enumerate(left_key)}
    mine = _packed(left, "_1", {"__array": array, **keys})
    theirs = _packed(right, "_2", {"__right": member})
    return membership_join(mine, theirs, "__array", "__right", how, list(keys)).select("_1", "_2")


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps k rows, so nothing is sorted globally.

    End ``order`` with a unique column, or ties are cut arbitrarily.
    """
    return df.orderBy(*order).limit(k)


def top_detail(detail: DataFrame, top: DataFrame, k: int, on: Sequence[str]) -> DataFrame:
    """Detail rows of a top-k, to be aggregated afterwards.

    ``top`` is limited to ``k`` rows; Spark picks the join by their size.
    """
    return detail.join(top.limit(k), list(on))
