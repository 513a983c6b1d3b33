"""Flattening nested documents into wide rows.

Every step is a function of the schema: it is planned on the driver without
reading data and runs as projections (and one explode) inside the scan stage,
so nothing here shuffles. Wide projections are written as SQL text: hundreds of
column objects would each take several calls to the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.arrays import Order, sort_steps
from corbel.functions.paths import column_at, path_sql, quoted, require_distinct


@dataclass(frozen=True)
class ArraySpec:
    """How one array column becomes columns.

    ``order`` sorts the elements: ``[(dotted field path, "ASC" | "DESC"), ...]``.
    ``slots`` names the output: ``{field path: {zero-based position: column}}``.
    """

    column: str
    order: Order = ()
    slots: Mapping[str, Mapping[int, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        require_distinct(self.names())
        if any(position < 0 for places in self.slots.values() for position in places):
            raise ValueError(f"negative position in the slots of {self.column!r}")

    def names(self) -> list[str]:
        """Output columns in slot order."""
        return [name for places in self.slots.values() for name in places.values()]


def numbered(prefix: str, count: int) -> dict[int, str]:
    """Slots ``{0: prefix_1, 1: prefix_2, ...}``."""
    return {position: f"{prefix}_{position + 1}" for position in range(count)}


def specs_from_maps(
    order: Mapping[str, Order], slots: Mapping[str, Mapping[str, Mapping[int, str]]]
) -> list[ArraySpec]:
    """Join a sort map and a slot map, in the order of the sort map.

    Arrays without slots are only dropped. Slots of an array that has no sort
    entry could never be produced, so they are refused.
    """
    stray = [name for name in slots if name not in order]
    if stray:
        raise ValueError(f"slots without a sort entry: {stray}")
    return [ArraySpec(name, keys, slots.get(name, {})) for name, keys in order.items()]


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all fields that are not structs, depth first.

    Arrays and maps are leaves.
    """
    paths: list[tuple[str, ...]] = []
    for item in schema.fields:
        path = (*prefix, item.name)
        if isinstance(item.dataType, T.StructType):
            paths += leaf_paths(item.dataType, path)
        else:
            paths.append(path)
    return paths


def pruned_schema(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The part of a schema that dotted paths reach, through structs and arrays of structs.

    A path that ends at a struct or an array keeps all of it. Reading files with this
    schema skips every other field, which Spark itself does not do for more than one
    field behind an explode, nor for any nested field of JSON. An unknown path is an error.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        if head not in schema.names:
            raise ValueError(f"the schema has no field {path!r}")
        wanted.setdefault(head, []).append(rest)
    return T.StructType([_pruned(item, wanted[item.name]) for item in schema if item.name in wanted])


def _pruned(item: T.StructField, rests: Sequence[str]) -> T.StructField:
    if not all(rests):
        return item
    kind, arrays = item.dataType, []
    while isinstance(kind, T.ArrayType):
        arrays.append(kind)
        kind = kind.elementType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{item.name} has no fields {list(rests)}")
    inner: T.DataType = pruned_schema(kind, rests)
    for array in reversed(arrays):
        inner = T.ArrayType(inner, array.containsNull)
    return T.StructField(item.name, inner, item.nullable, item.metadata)


def used_paths(
    schema: T.StructType,
    header: Mapping[str, str],
    array: str,
    name: str,
    specs: Iterable[ArraySpec],
    separator: str = "_",
) -> list[str]:
    """Paths that :func:`flatten_documents` with the same arguments reads, for :func:`pruned_schema`.

    Arrays that would only be dropped are left out; of those that become columns, only the
    fields that are sorted by or given a column.
    """
    by_column = {spec.column: spec for spec in specs}
    kind: T.DataType = schema
    for part in array.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            raise ValueError(f"the schema has no array {array!r}")
        kind = kind[part].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        raise ValueError(f"{array} is not an array of structs")
    paths = list(header.values())
    for leaf in leaf_paths(kind.elementType):
        spec = by_column.get(separator.join((name, *leaf)).replace(".", separator))
        whole = ".".join((array, *leaf))
        if spec is None:
            paths.append(whole)
        elif spec.names():
            fields = dict.fromkeys([*(path for path, _ in spec.order), *spec.slots])
            paths += [f"{whole}.{field}" for field in fields]
    return paths


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Give every struct leaf its own column, named by its whole path."""
    paths = leaf_paths(df.schema)
    names = require_distinct(
        separator.join(path).replace(".", separator) for path in paths
    )
    return df.selectExpr(
        *[f"{path_sql(path)} AS {quoted(name)}" for path, name in zip(paths, names)]
    )


def explode_array(
    df: DataFrame,
    header: Mapping[str, str],
    array: str,
    name: str,
    outer: bool = False,
    computed: bool = False,
) -> DataFrame:
    """One row per element of the array at a path, beside the header columns.

    ``header`` maps output names to dotted paths. Documents whose array is null
    or empty disappear unless ``outer`` is set.

    Set ``computed`` where the array is made by the query, by parsing text for
    instance. For an explode Spark infers a filter that the array is not empty:
    on a stored column it is cheap and lets the scan read single fields of the
    elements, but a computed array would be computed for it once more.
    """
    kept = [column_at(path).alias(label) for label, path in header.items()]
    # Narrowed first: a row of the explode must not carry the whole document.
    narrow = df.select(*kept, column_at(array).alias("__array"))
    labels = [column_at([label]) for label in header]
    if outer or not computed:
        explode = F.explode_outer if outer else F.explode
        return narrow.select(*labels, explode("__array").alias(name))
    # Only the row of an absent or empty array has no position.
    rows = narrow.select(*labels, F.posexplode_outer("__array").alias("__position", name))
    return rows.filter(F.col("__position").isNotNull()).drop("__position")


def pivot_arrays(df: DataFrame, specs: Iterable[ArraySpec]) -> DataFrame:
    """Sort each array and spread its elements over the columns of its spec.

    Positions past the end give null. An absent column is skipped, an array
    without struct elements or without slots is dropped, and a column that is no
    array is an error. All slots are produced by one projection over others, few,
    that sort the arrays, so each array is sorted once per row and the
    plan does not grow by one step per slot.
    """
    kinds = {item.name: item.dataType for item in df.schema.fields}
    consumed: set[str] = set()
    # Of each array: its column, that of what is sorted, the steps of the sort and the last slot.
    sorts: list[tuple[str, str, list[Callable[[Column], Column]], int]] = []
    slots: list[str] = []
    names: list[str] = []
    for spec in specs:
        kind = kinds.get(spec.column)
        if kind is None:
            continue
        if spec.column in consumed:
            raise ValueError(f"two specifications for {spec.column!r}")
        if not isinstance(kind, T.ArrayType):
            raise ValueError(f"{spec.column} is not an array")
        consumed.add(spec.column)
        if not isinstance(kind.elementType, T.StructType) or not spec.names():
            continue
        helper = f"{spec.column}__sorted"
        while helper in kinds:
            helper += "_"
        last = max(position for places in spec.slots.values() for position in places)
        sorts.append((spec.column, helper, sort_steps(spec.order, kind.elementType), last))
        names += spec.names()
        # get() is null past the end, also under ANSI mode.
        slots += [
            f"get({quoted(helper)}, {position}).{path_sql(path)} AS {quoted(name)}"
            for path, places in spec.slots.items()
            for position, name in places.items()
        ]
    kept = [name for name in df.columns if name not in consumed]
    require_distinct([*kept, *names])
    carried = [quoted(name) for name in kept]
    for turn in range(max((len(steps) for _, _, steps, _ in sorts), default=0)):
        helpers: list[Column] = []
        for column, helper, steps, last in sorts:
            entries = column_at([helper if turn else column])
            if turn < len(steps):
                entries = steps[turn](entries)
            if turn == len(steps) - 1:
                # No element past the last slot is carried to the next projection.
                entries = F.slice(entries, 1, last + 1)
            helpers.append(entries.alias(helper))
        df = df.select(*carried, *helpers)
    return df.selectExpr(*carried, *slots)


def flatten_documents(
    df: DataFrame,
    header: Mapping[str, str],
    array: str,
    name: str,
    specs: Iterable[ArraySpec],
    separator: str = "_",
    computed: bool = False,
) -> DataFrame:
    """Documents to wide rows: explode one array, flatten structs, pivot the rest."""
    base = explode_array(df, header, array, name, computed=computed)
    return pivot_arrays(flatten_structs(base, separator), specs)


def project_paths(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select dotted paths under the names given, ``{name: path}``."""
    require_distinct(mapping)
    return df.select(*[column_at(path).alias(name) for name, path in mapping.items()])


def rename_display(df: DataFrame, display: Mapping[str, str]) -> DataFrame:
    """Rename columns to display names; columns without one keep theirs."""
    names = require_distinct(display.get(name, name) for name in df.columns)
    return df.toDF(*names)


def select_accepted(df: DataFrame, accepted: Sequence[str]) -> DataFrame:
    """Keep the accepted columns the frame has, in the order of the list."""
    present = set(df.columns)
    return df.select(*[column_at([name]) for name in accepted if name in present])
