"""Compare registered queries with their SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """What differs between the two results; empty when nothing does."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _bag(names, expected.fetchall())
    got = _bag(df.columns, df.collect())
    if want == got:
        return ""
    missing, extra = want - got, got - want
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )
