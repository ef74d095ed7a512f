"""The list of queries: name, Spark job and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (
    "scan_plans",
    "write_plans",
    "column_plans",
    "join_plans",
    "aggregate_plans",
    "order_plans",
    "function_plans",
    "dedup_plans",
    "evolving_plans",
    "stream_plans",
)
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        _queries[function.__name__] = function
        if sql is not None:
            _sql[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"tablework.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
