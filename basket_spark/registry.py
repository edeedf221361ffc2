"""The queries and their SQL by name; modules of queries add theirs when they are imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .binding import CTE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL that starts after the entities' CTEs (see ``binding``)."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH {CTE}{sql}"
        return f

    return register


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def zeroed(*names: str, digits: int = 6) -> list[Column]:
    """Rounded, and no negative zero."""
    return [(F.round(n, digits) + 0.0).alias(n) for n in names]
