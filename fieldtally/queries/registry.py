"""The registry, and the SQL fragments that mirror the cell rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.functions.cells import INTEGER, NUMBER

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def queries() -> dict[str, Run]:
    return {name: q.run for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}


def r6(value: Column) -> Column:
    """Six places; adding 0 turns −0 into 0."""
    return F.round(value, 6) + F.lit(0.0)


# --- SQL fragments ---------------------------------------------------------------------------------


def sql_r6(value: str) -> str:
    return f"(round(CAST({value} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def sql_is_number(cell: str) -> str:
    return f"regexp_matches({cell}, '{NUMBER}')"


def sql_is_integer(cell: str) -> str:
    return f"regexp_matches(trim({cell}), '{INTEGER}')"


def sql_number(cell: str) -> str:
    return f"(CASE WHEN {sql_is_number(cell)} THEN TRY_CAST(trim({cell}) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


def sql_hash(salt: str, key: str) -> str:
    """``salt`` is an SQL expression."""
    return f"CAST(('0x' || substr(md5(concat({salt}, ':', CAST({key} AS VARCHAR))), 1, 8)) AS BIGINT)"


def sql_clean(cell: str, salt: str, key: str, case_sensitive: bool = False) -> str:
    seen = f"{cell} = 'x'" if case_sensitive else f"{cell} IN ('x', 'X')"
    return (
        f"(CASE WHEN {seen} THEN CAST(2 + {sql_hash(salt, key)} % 9 AS DOUBLE) ELSE {sql_number(cell)} END)"
    )


def sql_label(cell: str) -> str:
    return (
        f"(CASE WHEN {cell} IN ('x', 'X') THEN CAST(1 AS DOUBLE)"
        f" WHEN {sql_number(cell)} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)"
    )
