"""Addressing columns and struct fields by path."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Quote one name part, so dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def path_sql(parts: str | Sequence[str]) -> str:
    """SQL text of a path; a string is split at dots, a sequence is taken as is."""
    if isinstance(parts, str):
        parts = parts.split(".")
    return ".".join(quoted(part) for part in parts)


def column_at(parts: str | Sequence[str]) -> Column:
    """Column at a path, see :func:`path_sql`."""
    return F.col(path_sql(parts))


def field_at(column: Column, path: str) -> Column:
    """Field of a struct column at a dotted path."""
    return reduce(lambda inner, name: inner.getField(name), path.split("."), column)


def require_distinct(names: Iterable[str]) -> list[str]:
    """Return the names, or raise when two are equal but for case."""
    names = list(names)
    seen: set[str] = set()
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"two output columns share the name {name!r}")
        seen.add(name.lower())
    return names
