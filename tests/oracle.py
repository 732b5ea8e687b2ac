"""Runs a query's SQL on the same tables and compares rows."""

from __future__ import annotations

import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        p = f"{folder}/{f}"
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    return c


def rows_of(columns: list[str], rows) -> list[str]:
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(r[i] for i in at)) for r in rows)


def assert_same(spark, folder: str, query, sql: str) -> None:
    df = query(spark, folder)
    cursor = connect(folder).execute(sql)
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
