"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from supplyprep.catalog.tables import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = (
    "sources",
    "filters_joins",
    "groups",
    "graphs",
    "bom",
    "row_changes",
    "cleaning",
    "pipelines",
    "supply",
    "netting",
)


def query(name: str, sql: str | None = None):
    """Register ``name``; the function gets the tables and returns the result."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def registered_sql(name: str) -> str:
    """The SQL of a query registered before."""
    return _SQL[name]


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"supplyprep.catalog.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(function):
        return lambda spark, sf_dir: function(Tables(spark, sf_dir))

    return {name: bind(function) for name, function in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
