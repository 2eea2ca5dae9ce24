"""The registered queries of the library's own operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its oracle SQL where SQL can express it."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return add


_FIXED: dict[str, tuple[Query, str]] = {}


def fixed(name: str, sql: str) -> Callable[[Query], Query]:
    """Keep a check on a fixed small input, with its oracle SQL: tests run it, but it is no query."""

    def add(fn: Query) -> Query:
        _FIXED[name] = fn, sql
        return fn

    return add


def fixed_checks() -> dict[str, tuple[Query, str]]:
    import nephos.queries  # noqa: F401  its modules register themselves

    return dict(_FIXED)


def queries() -> dict[str, Query]:
    import nephos.queries  # noqa: F401  its modules register themselves

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    import nephos.queries  # noqa: F401

    return dict(_ORACLES)
