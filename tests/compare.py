"""Compare a Spark result with the rows DuckDB gives for the same question."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, connection, sql):
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted_rows(names, expected.fetchall())
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
