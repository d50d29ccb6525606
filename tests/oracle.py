"""Runs a registered query beside its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A view for each table that the folder holds."""
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name, kind = os.path.splitext(file)
        if kind == ".parquet":
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 4)
    return value


def as_rows(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


def spark_rows(frame) -> list[tuple]:
    return as_rows(frame.columns, [tuple(row) for row in frame.collect()])


_TYPES = {
    "VARCHAR": "string", "DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
}


def duck_rows(connection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    """Column types by Spark's names, and the rows."""
    result = connection.sql(sql)
    types = {n: _TYPES.get(str(t), str(t)) for n, t in zip(result.columns, result.types)}
    return types, as_rows(result.columns, result.fetchall())
