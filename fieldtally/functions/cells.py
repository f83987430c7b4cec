"""Cell rules: sentinels, numbers, labels and the seeded hash that replaces random draws.

Raw cells are strings: ``?`` is missing, ``x`` means seen but not counted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, and the range a seen-but-not-counted cell draws from.
NUMBER = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
INTEGER = r"^[+-]?[0-9]+$"
SEEN_RANGE = (2, 10)


def hash32(salt: str | int | Column, key: Column) -> Column:
    """0 … 2³²−1 from ``md5('<salt>:<key>')``: equal on every engine, partitioning and retry."""
    salt = salt if isinstance(salt, Column) else F.lit(str(salt))
    digest = F.md5(F.concat(salt, F.lit(":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def bucket(n: int, salt: str | int | Column, key: Column) -> Column:
    return hash32(salt, key) % F.lit(n)


def is_number(cell: Column) -> Column:
    return cell.rlike(NUMBER)


def is_integer(cell: Column) -> Column:
    return F.trim(cell).rlike(INTEGER)


def is_seen(cell: Column, case_sensitive: bool = False) -> Column:
    return cell == F.lit("x") if case_sensitive else cell.isin("x", "X")


def to_number(cell: Column) -> Column:
    """A number, or 0 for anything that is none.

    A number too large for a double is none. The pattern keeps out what the cast alone would accept (nan, inf, 1d, 0x1p3), and it comes first
    because a failing cast raises inside the JVM, which costs far more than a pattern that does not match.
    """
    number = F.when(is_number(cell), cell.try_cast("double"))
    return F.coalesce(F.when(F.abs(number) < F.lit(float("inf")), number), F.lit(0.0))


def clean_count(cell: Column, salt: str | int | Column, key: Column, case_sensitive: bool = False) -> Column:
    """``x`` → 2 … 10 drawn by hash, number → itself, ``?`` and all else → 0.

    The two frequent cells are tested first, so the pattern and the hash run on the rare ones only.
    """
    low, high = SEEN_RANGE
    drawn = (bucket(high - low + 1, salt, key) + F.lit(low)).cast("double")
    return (
        F.when(cell.isin("0", "?"), F.lit(0.0))
        .when(is_seen(cell, case_sensitive), drawn)
        .otherwise(to_number(cell))
    )


def binarize(value: Column) -> Column:
    return F.when(value == F.lit(0.0), F.lit(0.0)).otherwise(F.lit(1.0))


def target_label(cell: Column, case_sensitive: bool = False) -> Column:
    """0/1 label of the target cell: ``clean_count`` then ``binarize`` without drawing the count."""
    return F.when(is_seen(cell, case_sensitive), F.lit(1.0)).otherwise(binarize(to_number(cell)))


def target_value(cell: Column, salt: str | int | Column, key: Column, case_sensitive: bool = False) -> Column:
    """Direct label: ``x`` → 1, ``?`` → 0, 0 → 0, other number → 1, unparsable → a hashed coin."""
    coin = bucket(2, salt, key).cast("double")
    return (
        F.when(is_seen(cell, case_sensitive), F.lit(1.0))
        .when(cell == F.lit("?"), F.lit(0.0))
        .when(is_number(cell), binarize(to_number(cell)))
        .otherwise(coin)
    )


def replace_missing(cell: Column, missing: str = "?", by: str = "0") -> Column:
    return F.when(cell == F.lit(missing), F.lit(by)).otherwise(cell)


def month_number(cell: Column) -> Column:
    """The month as an integer, at least 1."""
    return F.greatest(F.lit(1.0), to_number(cell)).cast("int")


def impute_monthly(cell: Column, month: Column, siblings: dict[int, Column]) -> Column:
    """A missing cell takes the sibling of the row's ``month_number``; no such sibling → ``'0'``."""
    by_month = F.array(*[siblings.get(m, F.lit("0")) for m in range(1, max(siblings, default=1) + 1)])
    return F.when(cell == F.lit("?"), F.coalesce(F.get(by_month, month - 1), F.lit("0"))).otherwise(cell)
