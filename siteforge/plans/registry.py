"""Named queries and their SQL oracles."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a builder under ``name`` with the SQL that must return the same rows."""

    def add(f: Query) -> Query:
        assert name not in _QUERIES, name
        _QUERIES[name] = f
        if sql is not None:
            _ORACLES[name] = sql
        return f

    return add


def _load() -> None:
    from siteforge.plans import catalog  # noqa: F401  importing registers


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
