"""Dense numbering, running totals, sorting and set operations without single-task steps over the data."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldtally.session import materialize


def _starts(sizes: DataFrame) -> DataFrame:
    """(_part, _n) → (_part, _start): one row per range partition, so their number is bounded by the
    shuffle partitions whatever the data's size."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def zip_index(df: DataFrame, *order: str, alias: str = "index") -> DataFrame:
    """0-based dense index in the order of ``order``, which must identify a row.

    Range partition, sort and number inside each partition; the numbered rows are written once, because a
    second evaluation may draw other range bounds; then each partition's start is added by a tiny join.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    split = numbered.select(
        "*", F.shiftright("_slot", 33).alias("_part"), F.col("_slot").bitwiseAND(F.lit(2**33 - 1)).alias("_row")
    )
    starts = _starts(split.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    return split.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(alias)
    )


def input_index(lines: DataFrame, alias: str = "index") -> DataFrame:
    """0-based index of lines in the order of the input, for frames of ``read_lines(..., in_order=True)``.

    One pass counts the lines of each block of a file; the counts, one row for each block, give the offsets. Rows then number themselves
    in place: the block's offset, and their distance from its first row. They are neither shuffled nor written. Both passes must
    cut the files alike; if the session's split sizes changed in between, the query fails instead of numbering wrongly. Files come
    in the order of their paths.
    """
    block = [F.shiftright("_row", 33).alias("_part"), "_file", "_block", "_length"]
    blocks = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = lines.withColumn("_part", F.shiftright("_row", 33)).join(F.broadcast(starts), ["_part", "_file", "_block", "_length"], "left")
    changed = F.raise_error(F.lit("the input was cut into other blocks than before: set the same spark.sql.files options")).cast("bigint")
    index = F.when(F.col("_first").isNull(), changed).otherwise(F.col("_start") + F.col("_row") - F.col("_first"))
    return placed.select(*lines.columns, index.alias(alias))


def running_total(df: DataFrame, *order: str, amount: str, alias: str = "before") -> DataFrame:
    """Sum of ``amount`` over the rows before each row in the order of ``order``."""
    pinned = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "totals")
    starts = _starts(pinned.groupBy("_part").agg(F.sum(amount).alias("_n")))
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        pinned.withColumn("_within", F.coalesce(F.sum(amount).over(before), F.lit(0)))
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + F.col("_within")).alias(alias))
    )


def sort_by_key(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*order)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows; each task keeps its own ``n`` and only those are merged."""
    return df.orderBy(*order).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def cache_input(df: DataFrame) -> DataFrame:
    """For a cleaned frame that several jobs read; spills to disk and is recomputed when lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
