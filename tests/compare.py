"""Compare registered queries with their SQL oracles."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return value


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, con, query, sql: str, folder: str) -> str | None:
    """None when both give the same rows, else what differs."""
    result = query(spark, folder)
    relation = con.sql(sql)
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {sorted(result.columns)} != {sorted(relation.columns)}"
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"spark {g!r:.600} != sql {w!r:.600}"
    return None
