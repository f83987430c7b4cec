"""Least squares per shard from saved sufficient statistics, which merge with those of other files.

A state is one row for each shard: the row count, the means of the columns and their co-moments, centred, so that neither an offset
nor the order of merging costs digits. The last column is the target. Any number of states, of parts of a file or of later files, merge
into the state of all their rows; models are solved from states, never from rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A pivot below this share of its column's co-moment counts as none.
SINGULAR = 1e-12
STATE = "shard bigint, n bigint, means array<double>, moments array<double>"


def places(width: int) -> dict[tuple[int, int], int]:
    """Where the co-moment of columns i ≤ j stands in ``moments``."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    return {pair: k for k, pair in enumerate(pairs)}


def state_of(df: DataFrame, shard: Column, features: Sequence[str], target: str) -> DataFrame:
    """(shard, n, means, moments) in one partial aggregate; rows with a null in a column, or without a shard, are left out."""
    columns = [*features, target]
    rows = df.select(shard.cast("long").alias("shard"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).dropna()
    n = F.count(F.lit(1))
    return rows.groupBy("shard").agg(
        n.alias("n"),
        F.array(*[F.avg(f"c{i}") for i in range(len(columns))]).alias("means"),
        F.array(*[F.covar_pop(f"c{i}", f"c{j}") * n for i, j in places(len(columns))]).alias("moments"),
    )


def merge_states(states: DataFrame, width: int) -> DataFrame:
    """One state for each shard: moments add up, together with those of the parts' means around the common mean."""
    of_shard = Window.partitionBy("shard")
    common = [F.sum(F.col("n") * F.get("means", F.lit(i))).over(of_shard) / F.sum("n").over(of_shard) for i in range(width)]
    placed = states.select("shard", "n", "means", "moments", F.array(*common).alias("common"))
    away = [F.get("means", F.lit(i)) - F.get("common", F.lit(i)) for i in range(width)]
    moments = [F.sum(F.get("moments", F.lit(k)) + F.col("n") * away[i] * away[j]) for (i, j), k in places(width).items()]
    return placed.groupBy("shard").agg(F.sum("n").alias("n"), F.first("common").alias("means"), F.array(*moments).alias("moments"))


def solve_states(states: DataFrame, width: int) -> DataFrame:
    """(shard, n, intercept, b0 …) by Cholesky decomposition; a singular shard has null coefficients.

    Each entry of the triangle is a column of its own, made from earlier ones, so expressions do not grow with the width.
    """
    k, at = width - 1, places(width)

    def moment(i: int, j: int) -> Column:
        return F.get("moments", F.lit(at[min(i, j), max(i, j)]))

    df = states
    for i in range(k):
        for j in range(i):
            inner = sum((F.col(f"l{i}_{m}") * F.col(f"l{j}_{m}") for m in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}_{j}", (moment(i, j) - inner) / F.col(f"l{j}_{j}"))
        pivot = moment(i, i) - sum((F.col(f"l{i}_{m}") * F.col(f"l{i}_{m}") for m in range(i)), F.lit(0.0))
        df = df.withColumn(f"l{i}_{i}", F.sqrt(F.when(pivot > F.lit(SINGULAR) * moment(i, i), pivot)))
    for i in range(k):  # L z = t
        inner = sum((F.col(f"l{i}_{m}") * F.col(f"z{m}") for m in range(i)), F.lit(0.0))
        df = df.withColumn(f"z{i}", (moment(i, k) - inner) / F.col(f"l{i}_{i}"))
    for i in reversed(range(k)):  # Lᵀ b = z
        inner = sum((F.col(f"l{m}_{i}") * F.col(f"b{m}") for m in range(i + 1, k)), F.lit(0.0))
        df = df.withColumn(f"b{i}", (F.col(f"z{i}") - inner) / F.col(f"l{i}_{i}"))
    intercept = F.get("means", F.lit(k)) - sum((F.col(f"b{i}") * F.get("means", F.lit(i)) for i in range(k)), F.lit(0.0))
    return df.select("shard", "n", intercept.alias("intercept"), *[f"b{i}" for i in range(k)])


def save_state(state: DataFrame, features: Sequence[str], target: str, path: str, part: str) -> None:
    """Add one part to the folder of states, under its name, and the names of the columns beside it. A part written again is replaced."""
    spark = state.sparkSession
    names = json.dumps({"features": list(features), "target": target})
    spark.createDataFrame([(names,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/columns")
    state.write.mode("overwrite").parquet(f"{path}/states/part={part}")


def load_state(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], str]:
    """(merged state of all parts in the folder, features, target)."""
    names = json.loads(spark.read.text(f"{path}/columns").first()["value"])
    states = spark.read.schema(STATE).parquet(f"{path}/states/*")
    return merge_states(states, len(names["features"]) + 1), names["features"], names["target"]
