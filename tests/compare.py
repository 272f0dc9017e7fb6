"""Compare a Spark result with its SQL twin on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(
                f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def _cell(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter, dict[str, type]]:
    rows = [tuple(r) for r in df.collect()]
    return sorted(df.columns), rows_of(df.columns, rows)


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
