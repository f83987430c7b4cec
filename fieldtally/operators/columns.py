"""Choosing and naming columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.catalog import DROP_NAMES, DROP_PREFIXES, ColumnCatalog


def species_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The ``keep`` columns, then every column with the name shape of a species."""
    return df.select(*keep, *[e.name for e in ColumnCatalog.from_frame(df).species()])


def drop_columns(
    df: DataFrame, names: Iterable[str] = DROP_NAMES, prefixes: Iterable[str] = DROP_PREFIXES
) -> DataFrame:
    """Without the exact names and the prefixes, in one projection."""
    return df.select(*[e.unique_name for e in ColumnCatalog.from_frame(df).kept(names, prefixes)])


def label_first(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """The target as first column under the name ``label``; the others keep their order."""
    return df.select(F.col(target).alias(label), *[c for c in df.columns if c != target])


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def filter_value(df: DataFrame, column: str, value: str = "?") -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def first_field(split: DataFrame, cells: str = "cells", alias: str = "field") -> DataFrame:
    return split.select(F.get(F.col(cells), F.lit(0)).alias(alias))


def as_column(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)
