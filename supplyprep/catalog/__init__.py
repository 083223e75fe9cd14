"""Queries over the test tables: every operator on stand-in data, with its SQL counterpart."""

from supplyprep.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
