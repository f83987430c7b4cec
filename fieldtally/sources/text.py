"""Raw lines → cells. The files have no quoting or escapes, so a line is cut at the separator."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.catalog import ArrayCells, ColumnCatalog


def read_lines(
    spark: SparkSession, path: str, in_order: bool = False, partitions: int | None = None, without: str | None = None
) -> DataFrame:
    """Lines of a file or folder as ``value``, but those equal to ``without``; ``.bz2`` is decompressed in parallel splits.

    ``in_order=True`` adds ``_file``, ``_block`` and ``_row``, which sort as the input does, and ``_length``, the block's; ``input_index``
    numbers the lines from them.
    """
    lines = spark.read.text(path)
    if without is not None:
        lines = lines.filter(F.col("value") != F.lit(without))
    if partitions and not in_order:
        lines = lines.repartition(partitions)
    if in_order:
        lines = lines.select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_block_length").alias("_length"),
            F.monotonically_increasing_id().alias("_row"),
        )
    return lines


def read_header(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]


def split_cells(
    lines: DataFrame, line: str = "value", upto: int | None = None, sep: str = ",", head_upto: int = -1
) -> DataFrame:
    """Replace ``line`` by ``cells``. Beyond position ``upto`` the rest stays one uncut cell, which
    spares the work on trailing columns that nothing reads. ``head_upto`` adds ``head``, the first cells only."""

    def cut(last: int | None, alias: str) -> Column:
        return F.split(F.col(line), re.escape(sep), -1 if last is None else last + 2).alias(alias)

    kept = [F.col(c) for c in lines.columns if c != line]
    head = [cut(head_upto, "head")] if head_upto >= 0 else []
    return lines.select(*kept, *head, cut(upto, "cells"))


def cast_row(split: DataFrame, cells: str = "cells", alias: str = "numbers") -> DataFrame:
    """Every cell as double; a cell that is no number becomes null."""
    return split.withColumn(alias, F.transform(F.col(cells), lambda c: F.trim(c).try_cast("double")))


def to_columns(split: DataFrame, width: int, cells: str = "cells") -> DataFrame:
    """Cells as columns ``_1 … _<width>``."""
    return split.select(*[F.get(F.col(cells), F.lit(i)).alias(f"_{i + 1}") for i in range(width)])


def read_wide(
    spark: SparkSession,
    path: str,
    in_order: bool = False,
    needed: Sequence[str] | Callable[[ColumnCatalog], int] | None = None,
    tested: Sequence[str] = (),
    header: str | None = None,
) -> tuple[DataFrame, ArrayCells]:
    """A wide file → (frame with ``cells``, the layout of its cells).

    ``header`` is the line of column names of a file that has none; by default it is the file's first line. Lines equal to
    it are removed from every file of the folder. Cells after the last ``needed`` column stay one uncut cell; ``needed``
    may also tell the last position from the catalog, and by default all cells are cut. The columns that filters will test go
    into ``tested``; cells up to the last of them are cut separately.
    """
    header = read_header(spark, path) if header is None else header
    catalog = ColumnCatalog.from_header(header)
    if needed is None:
        upto = len(catalog) - 1
    elif callable(needed):
        upto = needed(catalog)
    else:
        upto = max(catalog.position(n) for n in needed)
    head_upto = max((catalog.position(n) for n in tested), default=-1)
    lines = read_lines(spark, path, in_order, without=header)
    return split_cells(lines, upto=upto, head_upto=head_upto), ArrayCells(catalog, head_upto=head_upto)


def count_records(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()
