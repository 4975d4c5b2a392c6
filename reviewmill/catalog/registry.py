"""Collects the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return keep


def _load() -> None:
    from reviewmill.catalog import (  # noqa: F401
        comparison_queries,
        io_queries,
        sentiment_queries,
        text_queries,
        word_queries,
    )


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
