"""Lenient date parsing and ages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def parse_dates(
    column: Column, formats: str | Sequence[str], pivot: int | None = None
) -> Column:
    """Parse text as a date with the first format that fits, null when none does.

    Two-digit years are read as 20xx. With ``pivot``, years above it belong to
    the century before: ``pivot=2028`` reads ``98`` as 1998 and ``28`` as 2028.
    """
    if isinstance(formats, str):
        formats = [formats]
    parsed = F.coalesce(*[F.try_to_date(column, fmt) for fmt in formats])
    if pivot is None:
        return parsed
    return F.when(F.year(parsed) > pivot, F.add_months(parsed, -1200)).otherwise(parsed)


def age_in_years(column: Column, as_of: dt.date | Column | None = None) -> Column:
    """Days since the date divided by 365; ``as_of`` defaults to today."""
    if as_of is None:
        as_of = F.curdate()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return F.datediff(as_of, column) / 365
