"""The core's queries and, where SQL can state them, their equivalents for another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    """Registers a query under its function's name."""
    QUERIES[f.__name__] = f
    return f
