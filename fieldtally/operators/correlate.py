"""Pearson and Spearman correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.gramian import correlations, find_shift, gramian
from fieldtally.operators.order import running_total
from fieldtally.operators.profile import array_moments
from fieldtally.session import materialize

NARROW = 16  # columns up to which each pair is an aggregate of its own
HEAVY = 256  # a value that one in so many rows holds is ranked by a broadcast


def _pearson(covariance: Column, first: Column, second: Column) -> Column:
    spread = first * second
    return covariance / F.when(spread > 0, spread)


def corr(a: str, b: str) -> Column:
    """Pearson over the rows where both sides are present; null, not an error, when a side is constant."""
    first = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a)))
    second = F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
    return _pearson(F.covar_pop(a, b), first, second)


def corr_series(df: DataFrame, a: str, b: str, alias: str = "r") -> DataFrame:
    return df.agg(corr(a, b).alias(alias))


def corr_target(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """(name, r) of the label against each named column, all in one aggregate."""
    one = df.agg(*[corr(label, c).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).alias("r")) for c in columns]
    return one.select(F.inline(F.array(*pairs)))


def corr_target_array(df: DataFrame, label: str, array: Column | str, width: int) -> DataFrame:
    """(pos, r) of the label against each position of an array."""
    return array_moments(df, array, width, label).select("pos", "r")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix of named columns in long form ``(i, j, r)``; i and j are names. Rows with a null
    in any of the columns are left out.

    A few columns are one aggregate with a covariance for each pair; more are summed up in tiles.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]).dropna()
    names = F.array(*[F.lit(c) for c in columns])
    if len(columns) > NARROW:
        positions = corr_matrix_array(rows.select(F.array(*rows.columns).alias("values")), "values", len(columns))
        return positions.select(F.get(names, "i").alias("i"), F.get(names, "j").alias("j"), "r")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = [F.covar_pop(f"c{i}", f"c{j}").alias(f"s{i}_{j}") for i, j in pairs]
    one = rows.agg(*sums, F.count(F.lit(1)).alias("n")).filter("n > 0")

    def r(i: int, j: int) -> Column:
        return _pearson(F.col(f"s{i}_{j}"), F.sqrt(f"s{i}_{i}"), F.sqrt(f"s{j}_{j}"))

    cells = [F.struct(F.lit(columns[i]).alias("i"), F.lit(columns[j]).alias("j"), r(min(i, j), max(i, j)).alias("r")) for i in range(len(columns)) for j in range(len(columns))]
    return one.select(F.inline(F.array(*cells)))


def corr_matrix_vector(df: DataFrame, features: str = "features") -> DataFrame:
    """Pearson matrix of a vector column as ``(i, j, r)`` positions; null where a side is constant.

    Sparse and dense rows of the same numbers give the same matrix; rows without a vector are left out.
    """
    rows = df.filter(F.col(features).isNotNull()).select(vector_to_array(features).alias("values"))
    width = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    return corr_matrix_array(rows, "values", width)


def corr_matrix_array(df: DataFrame, array: str, width: int | None = None) -> DataFrame:
    """Pearson matrix of the positions of an ``array<double>``, for any width; rows with a null entry are left out."""
    rows = _whole(df, array)
    if width is None:
        first = rows.select(F.size(array).alias("n")).first()
        width = first["n"] if first else 0
    if not width:
        return df.sparkSession.createDataFrame([], "i int, j int, r double")
    sums = gramian(rows, array, width, find_shift(rows, array, width))
    # Without rows there is no matrix, and not one of nulls.
    return correlations(sums, width) if rows.take(1) else correlations(sums, width).limit(0)


def _whole(df: DataFrame, array: str) -> DataFrame:
    values = F.col(array).cast("array<double>")
    return df.filter(F.col(array).isNotNull() & ~F.exists(values, F.isnull)).select(values.alias(array))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spearman matrix of named columns in long form ``(i, j, r)``. Rows with a null in any of the columns are left out
    before values are ranked."""
    rows = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("values"))
    names = F.array(*[F.lit(c) for c in columns])
    return spearman_matrix_array(rows, "values", len(columns)).select(F.get(names, "i").alias("i"), F.get(names, "j").alias("j"), "r")


def spearman_matrix_array(df: DataFrame, array: str, width: int) -> DataFrame:
    """Spearman matrix of the positions of an array: Pearson of the average ranks; rows with a null entry are left out.

    Values are counted by position and ranked in one range-ordered pass for all positions at once. Zeros are one tied value, neither
    exploded nor joined: entries are ranks less that of 0. Rows pick their ranks up by position and value. A value that many rows hold,
    ``HEAVY`` at most in a position, is looked up in a broadcast; the others are joined, none of which is a large key.
    """
    rows = materialize(_whole(df, array).withColumn("_row", F.monotonically_increasing_id()), "rows")
    n = rows.count()
    cells = rows.select("_row", F.posexplode(array).alias("pos", "v")).filter("v <> 0")
    counts = cells.groupBy("pos", "v").agg(F.count(F.lit(1)).alias("n"))
    before = materialize(running_total(counts, "pos", "v", amount="n"), "ranks")
    each = before.groupBy("pos").agg(
        F.min("before").alias("start"), F.sum("n").alias("held"), F.coalesce(F.sum(F.when(F.col("v") < 0, F.col("n"))), F.lit(0)).alias("negative")
    )
    zeros = F.lit(n) - F.col("held")
    rank = F.col("before") - F.col("start") + (F.col("n") + 1) / 2 + F.when(F.col("v") > 0, zeros).otherwise(0)
    entry = before.join(F.broadcast(each), "pos").select("pos", "v", "n", (rank - (F.col("negative") + (zeros + 1) / 2)).alias("entry"))
    heavy, light = (entry.filter(f).select("pos", "v", "entry") for f in (F.col("n") * HEAVY >= n, F.col("n") * HEAVY < n))
    looked = cells.join(F.broadcast(heavy), ["pos", "v"], "left")
    found = looked.filter("entry IS NOT NULL")
    joined = looked.filter("entry IS NULL").drop("entry").join(light, ["pos", "v"])
    every = found.select("_row", "pos", "entry").unionByName(joined.select("_row", "pos", "entry"))
    if width <= NARROW:  # a sum for each position takes the hash aggregate, a list would not
        entries = [F.sum(F.when(F.col("pos") == k, F.col("entry"))).alias(f"e{k}") for k in range(width)]
        ranked = every.groupBy("_row").agg(*entries).select(F.array(*[F.coalesce(f"e{k}", F.lit(0.0)) for k in range(width)]).alias("cells"))
    else:
        ranked = every.groupBy("_row").agg(F.collect_list(F.struct("pos", "entry")).alias("cells"))
    sums = gramian(ranked, "cells", width, sparse=width > NARROW)
    return correlations(sums, width, n) if n else df.sparkSession.createDataFrame([], "i int, j int, r double")
