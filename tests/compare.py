"""Comparing a Spark result with a DuckDB result: columns by name, rows as a bag."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(repr(_plain(row[i])) for i in order) for row in rows)


KINDS = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def differences(frame, connection, sql: str) -> list[str]:
    """What sets the two results apart; empty if they agree in names, types and rows."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    kinds = {column[0]: KINDS.get(str(column[1]), str(column[1])) for column in result.description}
    found = []
    if dict(frame.dtypes) != kinds:
        found.append(f"columns {sorted(frame.dtypes)} against {sorted(kinds.items())}")
    ours = bag(frame.columns, frame.collect())
    theirs = bag(names, result.fetchall())
    if ours != theirs:
        found.append(
            f"{ours.total()} rows against {theirs.total()}; "
            f"only ours {list((ours - theirs).items())[:3]}, only theirs {list((theirs - ours).items())[:3]}"
        )
    return found
