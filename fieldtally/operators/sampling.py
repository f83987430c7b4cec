"""Filters, seeded samples and splits.

Every draw is a hash of the row key, so a retry, a recomputation or another partitioning picks the same
rows, and none of these operators shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.cells import hash32, is_seen
from fieldtally.operators.columns import as_column

RANGE = 2**32  # of a draw


def below(draw: Column, share: float) -> Column:
    """True for that share of the draws, to within one of 2³²."""
    return F.lit(share >= 1.0) if share <= 0.0 or share >= 1.0 else draw < F.lit(round(share * RANGE))


@dataclass(frozen=True)
class Rates:
    """Share of rows to keep by target cell: ``x``, ``0``, ``?``, any other."""

    seen: float
    zero: float
    missing: float
    other: float


# The documented sampling rates.
BALANCE = Rates(seen=1.0, zero=1 / 2, missing=1 / 2, other=1.0)
BALANCE_TWO_THIRDS = Rates(seen=1.0, zero=2 / 3, missing=1 / 2, other=1.0)
CORRELATION = Rates(seen=1 / 2, zero=1 / 3, missing=1 / 3, other=0.0)


def filter_checklist(df: DataFrame, flag: Column | str, target: Column | str) -> DataFrame:
    """Primary checklists, and any row whose target is neither ``0`` nor ``?``."""
    return df.filter((as_column(flag) == F.lit("1")) | ~as_column(target).isin("0", "?"))


def filter_primary(df: DataFrame, flag: Column | str) -> DataFrame:
    return df.filter(as_column(flag) == F.lit("1"))


def filter_header(df: DataFrame, column: Column | str, name: str) -> DataFrame:
    """Without header rows left inside the data: rows that hold a column's name as its value."""
    return df.filter(~as_column(column).eqNullSafe(F.lit(name)))


def subtract_lines(lines: DataFrame, header: DataFrame, line: str = "value") -> DataFrame:
    """Without every line that occurs in ``header``; repeats of other lines stay. ``header`` is a few lines."""
    return lines.join(header.select(line).distinct(), line, "left_anti")


def keep_by_rate(
    df: DataFrame,
    target: Column | str,
    key: Column | str,
    rates: Rates,
    salt: str | int,
    case_sensitive: bool = False,
) -> DataFrame:
    cell, draw = as_column(target), hash32(salt, as_column(key))
    return df.filter(
        F.when(is_seen(cell, case_sensitive), below(draw, rates.seen))
        .when(cell == F.lit("0"), below(draw, rates.zero))
        .when(cell == F.lit("?"), below(draw, rates.missing))
        .otherwise(below(draw, rates.other))
    )


def class_balance(
    df: DataFrame,
    target: Column | str,
    key: Column | str,
    rates: Rates = BALANCE,
    salt: str | int = "balance",
    case_sensitive: bool = False,
) -> DataFrame:
    return keep_by_rate(df, target, key, rates, salt, case_sensitive)


def target_sample(
    df: DataFrame,
    target: Column | str,
    key: Column | str,
    rates: Rates = CORRELATION,
    salt: str | int = "corr",
    case_sensitive: bool = False,
) -> DataFrame:
    return keep_by_rate(df, target, key, rates, salt, case_sensitive)


def random_split(
    df: DataFrame, key: Column | str, weights: Mapping[str, float], salt: str | int, alias: str = "split"
) -> DataFrame:
    """Adds the name of the part each row falls into; weights need not sum to 1."""
    draw, total, upper = hash32(salt, as_column(key)), sum(weights.values()), 0.0
    part, names = None, list(weights)
    for name in names[:-1]:
        upper += weights[name]
        inside = below(draw, upper / total)
        part = F.when(inside, F.lit(name)) if part is None else part.when(inside, F.lit(name))
    return df.withColumn(alias, F.lit(names[-1]) if part is None else part.otherwise(F.lit(names[-1])))


def nested_sample(
    df: DataFrame,
    key: Column | str,
    outer: Mapping[str, float],
    inner: Mapping[str, float],
    salts: tuple[str | int, str | int] = ("outer", "inner"),
) -> DataFrame:
    """The last part of ``inner`` inside the last part of ``outer``: 9/1 in 9/1 keeps about 1 %."""
    held = random_split(df, key, outer, salts[0], "_outer").filter(F.col("_outer") == F.lit(list(outer)[-1]))
    kept = random_split(held, key, inner, salts[1], "_inner").filter(F.col("_inner") == F.lit(list(inner)[-1]))
    return kept.drop("_outer", "_inner")


def replicate(df: DataFrame, copies: int, alias: str = "model") -> DataFrame:
    """Each row once for every model key. Training does not need it: members read one cached frame."""
    return df.withColumn(alias, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
