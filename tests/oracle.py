"""Compare registered queries with DuckDB on the given tables."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(row[i]) for i in order] for row in rows), key=repr)


def differences(df, connection, sql: str) -> str | None:
    """None when columns, row count and values agree, else what differs."""
    found = [tuple(r) for r in df.collect()]
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = result.fetchall()
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    mine, theirs = _rows(df.columns, found), _rows(names, expected)
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} != {b}"
    return None
