"""Registered queries over the driver tables, each next to its SQL."""

from reviewmill.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
