"""All queries of the retail operators, and their SQL."""

from __future__ import annotations

from . import queries, queries_allocation, queries_cards, queries_loads, queries_pricing  # noqa: F401  each registers its queries
from .registry import QUERIES, SQL, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
