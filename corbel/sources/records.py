"""Binding frames to declared record types, nested ones too."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.functions.paths import column_at, quoted

#: Whole numbers from narrow to wide, and the digits that each may have.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_ZERO = {
    T.StringType: "",
    T.BinaryType: b"",
    T.BooleanType: False,
    T.DateType: dt.date(1970, 1, 1),
    T.TimestampType: dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc),
    T.TimestampNTZType: dt.datetime(1970, 1, 1),
}


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if have == want or isinstance(have, T.NullType):
        return True
    digits = _DIGITS.get(type(have))
    if digits is not None:
        if isinstance(want, T.DecimalType):
            return want.precision - want.scale >= digits
        if isinstance(want, (T.FloatType, T.DoubleType)):
            return digits <= (5 if isinstance(want, T.FloatType) else 10)
        return digits <= _DIGITS.get(type(want), 0)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        whole = want.precision - want.scale >= have.precision - have.scale
        return whole and want.scale >= have.scale
    return isinstance(have, T.FloatType) and isinstance(want, T.DoubleType)


def _some(kind: T.DataType) -> Column:
    """A value of the type that is not null; it stands where an error is raised instead."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_some(item.dataType).alias(item.name) for item in kind])
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    return F.lit(_ZERO.get(type(kind), 0)).cast(kind)


def _present(value: Column, kind: T.DataType, path: str) -> Column:
    """The value, typed as never null; a null raises an error that names the path."""
    return F.coalesce(value, F.raise_error(F.lit(f"null in {path}")).cast(kind), _some(kind))


class _Binder:
    """Expressions that bind values to a declared type, and what stands against it."""

    def __init__(self) -> None:
        self.problems: list[str] = []

    def bound(
        self, value: Column, have: T.DataType, want: T.DataType, path: str,
        may_be_null: bool, null_allowed: bool,
    ) -> Column:
        made = self._typed(value, have, want, path)
        return _present(made, want, path) if may_be_null and not null_allowed else made

    def _typed(self, value: Column, have: T.DataType, want: T.DataType, path: str) -> Column:
        if isinstance(have, T.NullType):
            return F.lit(None).cast(want)
        kinds = (T.StructType, T.ArrayType, T.MapType)
        nested = next((kind for kind in kinds if isinstance(want, kind)), None)
        if nested is None or not isinstance(have, nested):
            if nested is not None or isinstance(have, kinds) or not _widens(have, want):
                self.problems.append(f"{path}: {have.simpleString()} is no {want.simpleString()}")
            return value if have == want else value.cast(want)
        if nested is T.StructType:
            fields = self.fields(lambda item: value.getField(item.name), have, want, path)
            return F.when(value.isNotNull(), F.struct(*fields))
        if nested is T.ArrayType:
            return F.transform(
                value,
                lambda item: self.bound(
                    item, have.elementType, want.elementType, f"{path}[]",
                    have.containsNull, want.containsNull,
                ),
            )
        keyed = F.transform_keys(
            value, lambda key, _: self._typed(key, have.keyType, want.keyType, f"{path}{{key}}")
        )
        return F.transform_values(
            keyed,
            lambda _, item: self.bound(
                item, have.valueType, want.valueType, f"{path}{{}}",
                have.valueContainsNull, want.valueContainsNull,
            ),
        )

    def fields(
        self, value_of: Callable[[T.StructField], Column], have: T.StructType, want: T.StructType, path: str
    ) -> list[Column]:
        made = []
        for item in want:
            where = f"{path}.{item.name}" if path else item.name
            if item.name not in have.names:
                self.problems.append(f"{where}: missing")
                continue
            own = have[item.name]
            bound = self.bound(value_of(own), own.dataType, item.dataType, where, own.nullable, item.nullable)
            made.append(bound.alias(item.name))
        return made


def bind_record(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the declared names, order and types, through structs, arrays and maps.

    Fields are matched by name at every level, put into the declared order and widened;
    others are dropped, and what is declared without nulls is typed so. All fields that are missing or of another type are
    named by path in one error, before anything runs. A field declared
    without nulls may come from one that could hold them (files say so of all fields):
    the rows decide, and a null there ends the job with an error that names the path.
    """
    binder = _Binder()
    columns = binder.fields(lambda item: column_at([item.name]), df.schema, schema, "")
    if binder.problems:
        raise ValueError("the frame is no such record: " + "; ".join(binder.problems))
    bound = df.select(*columns)
    missed = [x.name for x, y in zip(schema, bound.schema) if not x.nullable and y.nullable]
    if missed:
        raise ValueError(f"cannot be bound without nulls: {', '.join(map(quoted, missed))}")
    return bound
