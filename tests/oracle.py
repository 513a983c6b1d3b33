"""Comparison of a Spark query with its SQL oracle in DuckDB."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _counted(names, rows):
    order = sorted(range(len(names)), key=lambda n: names[n])
    return Counter(tuple(_plain(row[n]) for n in order) for row in rows)


def compare(df, connection, sql):
    """Raise unless both give the same columns, types and multiset of rows."""
    result = connection.execute(sql)
    theirs = {column[0]: str(column[1]) for column in result.description}
    mine = {name: DUCK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    assert mine == theirs, f"columns differ: {mine} and {theirs}"
    wanted = _counted(list(theirs), result.fetchall())
    found = _counted(df.columns, df.collect())
    extra, missing = found - wanted, wanted - found
    assert not extra and not missing, (
        f"{sum(extra.values())} extra rows, {sum(missing.values())} missing of "
        f"{sum(wanted.values())}: {list(extra)[:2]} / {list(missing)[:2]}"
    )
    return sum(found.values())
