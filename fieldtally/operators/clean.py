"""Cleaning whole frames: sentinel cells to numbers, monthly imputation, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.functions import cells as c


def clean_counts(
    df: DataFrame, columns: Iterable[str], key: str, case_sensitive: bool = False
) -> DataFrame:
    """Clean named columns in place; the column name is the salt of its draws."""
    cleaned = {n: c.clean_count(F.col(n), n, F.col(key), case_sensitive) for n in columns}
    return df.withColumns(cleaned) if cleaned else df


def clean_array(
    df: DataFrame, array: str, key: str, salt: str = "", case_sensitive: bool = False
) -> DataFrame:
    """Clean an ``array<string>`` in one pass; salt and index seed the draws."""

    def rule(cell, index):
        return c.clean_count(cell, F.concat(F.lit(salt), index.cast("string")), F.col(key), case_sensitive)

    return df.withColumn(array, F.transform(F.col(array), rule))


def clean_remaining(
    df: DataFrame,
    key: str,
    species: Sequence[str] = (),
    dropped: Sequence[str] = (),
    aside: Sequence[str] = (),
    case_sensitive: bool = False,
) -> DataFrame:
    """The rule of ``clean_counts`` on each column that is neither species nor dropped nor set aside."""
    skip = {key, *species, *dropped, *aside}
    return clean_counts(df, [n for n in df.columns if n not in skip], key, case_sensitive)


def clean_all(
    df: DataFrame,
    key: str,
    species: Sequence[str] = (),
    dropped: Sequence[str] = (),
    aside: Sequence[str] = (),
    case_sensitive: bool = False,
) -> DataFrame:
    """Species columns, then the remaining ones."""
    counted = clean_counts(df, species, key, case_sensitive)
    return clean_remaining(counted, key, species, dropped, aside, case_sensitive)


def replace_value(df: DataFrame, value: str = "?", by: str = "0") -> DataFrame:
    """``value`` → ``by`` in every string column."""
    return df.replace(value, by)


def impute_columns(df: DataFrame, month: str, climate: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """Each climate column from its monthly siblings: ``{column: {month: sibling}}``."""
    numbered = df.withColumn("_month", c.month_number(F.col(month).cast("string")))
    imputed = {
        name: c.impute_monthly(F.col(name), F.col("_month"), {m: F.col(s) for m, s in siblings.items()})
        for name, siblings in climate.items()
    }
    return numbered.withColumns(imputed).drop("_month")
