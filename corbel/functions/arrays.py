"""Array expressions: tokens, safe element access and ordering of structs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.paths import field_at

Order = Sequence[tuple[str, str]]


def tokens(column: Column, separators: str = " |,") -> Column:
    """Split text at every match of a pattern; empty tokens are kept."""
    return F.split(column, separators)


def element(column: Column, position: int) -> Column:
    """Zero-based element, null past the end (also under ANSI mode)."""
    return F.get(column, F.lit(position))


def descending(direction: str) -> bool:
    """Only ``DESC`` (any case) is descending; everything else is ascending."""
    return direction.upper() == "DESC"


def comparator(order: Order) -> Callable[[Column, Column], Column]:
    """Comparison of two structs, key by key in the order given.

    The next key is looked at only where all keys before it tie. Ascending
    keys put nulls first, descending ones last. Each key is compared before the
    rarer null cases, and no sub-expression is evaluated twice.
    """

    def compare(left: Column, right: Column) -> Column:
        outcome = F.lit(0)
        for path, direction in reversed(order):
            mine, other = field_at(left, path), field_at(right, path)
            before, after = (1, -1) if descending(direction) else (-1, 1)
            outcome = (
                F.when(mine < other, before)
                .when(mine > other, after)
                .when(mine.eqNullSafe(other), outcome)
                .when(mine.isNull(), before)
                .otherwise(after)
            )
        return outcome

    return compare


def _orderable(kind: T.DataType) -> bool:
    """Whether Spark can compare values of the type."""
    if isinstance(kind, T.StructType):
        return all(_orderable(item.dataType) for item in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _field_type(kind: T.DataType, path: str) -> T.DataType:
    """Type of a struct field at a dotted path."""
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            raise ValueError(f"array elements have no field {path!r}")
        kind = kind[name].dataType
    return kind


def _reversible(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DateType))


def _reversed(value: Column, kind: T.DataType) -> list[Column]:
    """Fields that order the other way round: nulls too, and without overflow."""
    number = F.unix_date(value) if isinstance(kind, T.DateType) else value
    return [value.isNull(), F.bitwise_not(number)]


def _leading(order: Order, kinds: Sequence[T.DataType]) -> bool | None:
    """The direction in which all keys can be compared, None if there is none.

    A key of a whole number or a date can be turned round, others cannot.
    """
    fixed = {descending(way) for (_, way), kind in zip(order, kinds) if not _reversible(kind)}
    if len(fixed) > 1:
        return None
    return fixed.pop() if fixed else descending(order[0][1])


def _runs(order: Order, kinds: Sequence[T.DataType]) -> list[tuple[Order, Sequence[T.DataType], bool]]:
    """Keys split into runs that can each be compared in one direction (third: downwards)."""
    runs: list[tuple[Order, Sequence[T.DataType], bool]] = []
    first = 0
    for last in range(1, len(order) + 1):
        if last == len(order) or _leading(order[first : last + 1], kinds[first : last + 1]) is None:
            run, types = order[first:last], kinds[first:last]
            runs.append((run, types, bool(_leading(run, types))))
            first = last
    return runs


def _ranked(
    entries: Column, item: Callable[[Column], Column], run: Order, kinds: Sequence[T.DataType], downwards: bool
) -> Column:
    """Entries sorted by one run of keys, as structs with the ``item`` of each."""

    def keyed(entry: Column, position: Column) -> Column:
        value = item(entry)
        keys: list[Column] = []
        for (path, way), kind in zip(run, kinds):
            field = field_at(value, path)
            keys += [field] if descending(way) == downwards else _reversed(field, kind)
        # Equal keys keep their input order, in either direction.
        keys.append(-position if downwards else position)
        named = [key.alias(f"key{n}") for n, key in enumerate(keys)]
        return F.struct(*named, value.alias("item"))

    return F.sort_array(F.transform(entries, keyed), asc=not downwards)


def _zipped(entries: Column, run: Order, downwards: bool) -> Column:
    """What :func:`_ranked` gives, for keys that need no turning round; ``entries`` is a column.

    Only the places are made by a lambda, so no element is copied for the sort. That one
    also keeps the projection out of whole-stage code, whose methods get too long to be compiled.
    """
    keys = [field_at(entries, path).alias(f"key{n}") for n, (path, _) in enumerate(run)]
    # Equal keys keep their input order, in either direction.
    places = F.transform(entries, lambda _, position: -position if downwards else position)
    return F.sort_array(F.arrays_zip(*keys, places.alias("place"), entries.alias("item")), asc=not downwards)


def sort_steps(order: Order, item: T.StructType) -> list[Callable[[Column], Column]]:
    """The sort of :func:`sort_structs` in steps, each to be a projection of its own.

    A step takes the column that the step before it made; the first takes the array.
    """
    kinds = [_field_type(item, path) for path, _ in order]
    if not order or not _orderable(item):
        return [lambda column: sort_structs(column, order, item)]

    def step(run: Order, types: Sequence[T.DataType], downwards: bool) -> Callable[[Column], Column]:
        if all(descending(way) == downwards for _, way in run):
            return lambda entries: _zipped(entries, run, downwards)["item"]
        return lambda entries: _ranked(entries, lambda entry: entry, run, types, downwards)["item"]

    return [F.array_compact, *(step(*run) for run in reversed(_runs(order, kinds)))]


def sort_structs(column: Column, order: Order, item: T.StructType | None = None) -> Column:
    """Stable sort of an array of structs; null elements are removed.

    ``item`` is the type of the elements. Where it is known, the keys are put in front of
    each element and Spark's own array sort does the work. Keys are brought to one
    direction where their types allow; keys that cannot be (two texts in opposite
    directions) are sorted in runs of one direction, the last run first, each keeping the
    order found. Otherwise a comparator is interpreted for each pair it looks at.
    """
    present = F.array_compact(column)
    if not order:
        return present
    if item is None:
        return F.array_sort(present, comparator(order))
    kinds = [_field_type(item, path) for path, _ in order]
    if not _orderable(item):
        return F.array_sort(present, comparator(order))
    *earlier, last = _runs(order, kinds)
    ranked = _ranked(present, lambda entry: entry, *last)
    for run in reversed(earlier):
        ranked = _ranked(ranked, lambda entry: entry["item"], *run)
    # A field of all elements, not a lambda: around one, the sort would be interpreted too.
    return ranked["item"]
