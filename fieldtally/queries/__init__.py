"""Registered queries: each a Spark function over the given tables, most with an equivalent SQL text."""

from fieldtally.queries import (  # noqa: F401
    boosting,
    certificates,
    cleaning,
    columns,
    engineering,
    models,
    ordering,
    regression,
    sampling,
    scans,
    statistics,
)
from fieldtally.queries.registry import QUERIES, oracle_sql, queries

__all__ = ["QUERIES", "oracle_sql", "queries"]
