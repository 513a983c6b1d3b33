"""Predicates assembled from run-time lists."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(predicates: Iterable[Column]) -> Column:
    """Disjunction of the predicates; false when there are none."""
    return reduce(or_, predicates, F.lit(False))


def contains_any(column: Column, needles: Iterable[str]) -> Column:
    """True where the text holds at least one of the needles."""
    return any_of(column.contains(needle) for needle in needles)


def alternation(needles: Iterable[str]) -> str:
    """Regular expression matching any of the needles literally."""
    return "|".join(re.escape(needle) for needle in needles)


def matches_any(column: Column, needles: Iterable[str]) -> Column:
    """Regular-expression form of :func:`contains_any`."""
    pattern = alternation(needles)
    # An empty alternation would match every row.
    return column.rlike(pattern) if pattern else F.lit(False)


def extracts(column: Column, pattern: str) -> Column:
    """True where ``pattern`` matches a non-empty piece; null on a null text."""
    return F.regexp_extract(column, pattern, 0) != ""


def or_zero(column: Column) -> Column:
    """The value, or zero where it is null."""
    return F.coalesce(column, F.lit(0))
