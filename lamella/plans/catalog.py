"""All registered queries of the imaging operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("q_manifest", "q_select", "q_geometry", "q_volume", "q_surface", "q_fields", "q_register")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = sql
        return f

    return add


def _load() -> None:
    for module in _MODULES:
        import_module(f"lamella.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL
