"""Saved moments of every position, which merge with those of later files; scaling and correlation read them instead of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATE = "pos int, n bigint, mean double, m2 double, y_mean double, y_m2 double, co double"


def merge_moments(states: DataFrame) -> DataFrame:
    """One row for each position: sums add up, together with those of the parts' means around the common mean.

    A part without an entry at a position adds nothing there; a position without any has null moments.
    """
    of_pos = Window.partitionBy("pos")

    def common(mean: str):
        filled = F.when(F.col("n") > 0, F.col("n"))
        return F.sum(filled * F.col(mean)).over(of_pos) / F.sum(filled).over(of_pos)

    placed = states.withColumns({"_x": common("mean"), "_y": common("y_mean")})
    n, x, y = F.col("n"), F.col("mean") - F.col("_x"), F.col("y_mean") - F.col("_y")
    return placed.groupBy("pos").agg(
        F.sum("n").alias("n"),
        F.first("_x").alias("mean"),
        F.sum(F.col("m2") + n * x * x).alias("m2"),
        F.first("_y").alias("y_mean"),
        F.sum(F.col("y_m2") + n * y * y).alias("y_m2"),
        F.sum(F.col("co") + n * x * y).alias("co"),
    )


def save_moments(state: DataFrame, path: str, part: str) -> None:
    """One part of a folder of states; a part written again is replaced."""
    state.write.mode("overwrite").parquet(f"{path}/part={part}")


def load_moments(spark: SparkSession, path: str) -> DataFrame:
    """The merged state of all parts in the folder."""
    return merge_moments(spark.read.schema(STATE).parquet(f"{path}/part=*"))
