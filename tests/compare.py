"""Compare a Spark result with a DuckDB result, ignoring row order."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _naive(value):
    return value.replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_naive(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def assert_same(frame, connection, sql):
    result = connection.execute(sql)
    expected = _rows([d[0] for d in result.description], result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    for got, want in zip(actual[1], expected[1]):
        assert repr(got) == repr(want)
