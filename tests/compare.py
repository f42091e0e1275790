"""Run registered queries and their SQL equivalents side by side."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


_FAMILIES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, type families and all values agree, order of rows aside."""
    cursor = con.execute(sql)
    other_types = {d[0]: str(d[1]) for d in cursor.description}
    own_types = {name: _FAMILIES.get(kind, kind) for name, kind in df.dtypes}
    if own_types != other_types:
        only = {k: (own_types.get(k), other_types.get(k)) for k in own_types | other_types
                if own_types.get(k) != other_types.get(k)}
        return [f"columns or types differ: {only}"]
    own = _rows(list(own_types), [tuple(r) for r in df.collect()])
    other = _rows(list(other_types), cursor.fetchall())
    if len(own) != len(other):
        return [f"{len(own)} rows against {len(other)}"]
    wrong = [(a, b) for a, b in zip(own, other) if a != b]
    return [f"{len(wrong)} rows differ, first {wrong[0]}"] if wrong else []
