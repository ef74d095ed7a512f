"""Runs a query in Spark and its SQL twin in DuckDB and compares the rows."""

from __future__ import annotations

from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, (bool,)):
        return f"bool {value}"
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, pd.Timestamp):
        return f"time {value.isoformat()}"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, int):
        return f"int {value}"
    return f"{type(value).__name__} {value}"


def rows(frame: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    """Column names in order, and the rows as a sorted list of plain values."""
    columns = sorted(frame.columns)
    values = zip(*[[_plain(v) for v in frame[c].tolist()] for c in columns])
    return columns, sorted(values)
