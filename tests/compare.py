"""Rows of a query against rows of its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return connection


def rows_of(rows: list, columns: list[str], names: list[str]) -> list[tuple]:
    order = [columns.index(n) for n in names]
    plain = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: [(x is not None, str(x)) for x in r])


def assert_same(df, connection: duckdb.DuckDBPyConnection, sql: str) -> None:
    found = connection.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    ours, theirs = rows_of(df.collect(), df.columns, names), rows_of(found.fetchall(), found.columns, names)
    assert len(ours) == len(theirs)
    assert ours == theirs
