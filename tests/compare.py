"""Compare a Spark result with a DuckDB result: names, number of rows, values in any order."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem".split()


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else float(f"{number:.12g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    normal = [tuple(_normal(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(normal, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    expected_names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    names, found = _rows(df.columns, df.collect())
    if names != expected_names:
        return [f"columns {sorted(set(names) ^ set(expected_names))}"]
    if len(found) != len(expected):
        return [f"{len(found)} rows instead of {len(expected)}"]
    return [f"{dict(zip(names, a))} != {dict(zip(names, b))}" for a, b in zip(found, expected) if a != b]
