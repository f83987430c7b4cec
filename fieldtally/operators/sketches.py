"""Sketches of every column of a wide record: how many values, and which ones are frequent, in one pass.

A state is one row for each position: rows, missing cells, a HyperLogLog sketch of the values and a table of frequent items. States of
parts of a file or of later files merge into the state of all their rows. Cells are aggregated in tiles of ``TILE`` positions: a task holds
one sketch pair for each position, whatever the number of rows, and the number of groups stays below that at which
object aggregation falls back to a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.columns import as_column

TILE = 32
GROUPS = 128  # beyond it object aggregation sorts
LOG_SIZE = 12  # 2¹² registers: a standard deviation of 1.04 / √4096 = 1.6 %
TRACKED = 192  # items of a frequency table, which then has 256 places
TOP = "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
STATE = f"pos int, n bigint, missing bigint, sketch binary, top {TOP}"


def distinct_deviation() -> float:
    """Relative standard deviation of an estimated number of values."""
    return 1.04 / 2 ** (LOG_SIZE / 2)


def share_error() -> float:
    """A frequent value's count is at most this share of the rows too high, and never too low; values of twice the share are listed."""
    places = 1 << (-(-TRACKED * 4 // 3) - 1).bit_length()
    return 3.5 / places


def sketch_cells(df: DataFrame, cells: Column | str, width: int) -> DataFrame:
    """The state of an ``array<string>`` of ``width`` cells; a null cell, or one after the end of a short row, is missing.

    An empty frame gives no rows.
    """
    tile = max(TILE, -(-width // GROUPS))
    tiles = -(-width // tile)
    slices = F.transform(F.sequence(F.lit(0), F.lit(tiles - 1)), lambda t: F.slice(F.col("cells"), t * tile + 1, tile))
    rows = df.select(as_column(cells).alias("cells")).select(F.posexplode(slices).alias("tile", "cells"))
    cell = [F.get("cells", F.lit(k)).alias(f"c{k}") for k in range(tile)]
    n = F.count(F.lit(1))
    of_cell = [
        F.struct(
            F.lit(k).alias("k"),
            n.alias("n"),
            (n - F.count(f"c{k}")).alias("missing"),
            # Marked, because the sketch leaves out empty texts, and an empty cell is a value.
            F.hll_sketch_agg(F.concat(F.lit("="), f"c{k}"), F.lit(LOG_SIZE)).alias("sketch"),
            F.expr(f"approx_top_k_accumulate(c{k}, {TRACKED})").alias("top"),
        )
        for k in range(tile)
    ]
    tiled = rows.select("tile", *cell).groupBy("tile").agg(F.array(*of_cell).alias("states"))
    flat = tiled.select("tile", F.inline("states"))
    placed = flat.select((F.col("tile") * tile + F.col("k")).alias("pos"), "n", "missing", "sketch", "top")
    return placed.filter(F.col("pos") < width)


def sketch_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The state of named columns, in their order, values as text."""
    return sketch_cells(df, F.array(*[F.col(c).cast("string") for c in columns]), len(columns))


def merge_sketches(states: DataFrame) -> DataFrame:
    return states.groupBy("pos").agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("sketch").alias("sketch"),
        F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"),
    )


def read_sketches(states: DataFrame, names: Sequence[str], k: int = 10) -> DataFrame:
    """(pos, name, n, missing, distinct, frequent): estimates, and up to ``k`` frequent values with their counts, most frequent first.

    A null is counted as missing, not as a value.
    """
    frequent = F.filter(F.expr(f"approx_top_k_estimate(top, {k + 1})"), lambda e: e["item"].isNotNull())
    return states.select(
        "pos",
        F.get(F.array(*[F.lit(n) for n in names]), F.col("pos")).alias("name"),
        "n",
        "missing",
        F.hll_sketch_estimate("sketch").alias("distinct"),
        F.slice(frequent, 1, k).alias("frequent"),
    )


def category_counts(df: DataFrame, cells: Column | str, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """(name, value, rows), exactly, for the given positions: what the sketches found to have few values. Nulls are left out."""
    pairs = [F.struct(F.lit(name).alias("name"), F.get("cells", F.lit(p)).alias("value")) for p, name in zip(positions, names, strict=True)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "name string, value string, rows bigint")
    long = df.select(as_column(cells).alias("cells")).select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("rows"))


def save_sketches(state: DataFrame, path: str, part: str) -> None:
    """One part of a folder of states; a part written again is replaced."""
    state.write.mode("overwrite").parquet(f"{path}/part={part}")


def load_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The merged state of all parts in the folder."""
    return merge_sketches(spark.read.schema(STATE).parquet(f"{path}/part=*"))
