"""Queries of the engine by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with DuckDB SQL for the same rows if SQL can express them."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from lodeweave.plans import extraction, flows, graphs, reports, search, store, text  # noqa: F401 - they register their queries


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
