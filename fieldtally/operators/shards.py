"""Models per shard: exact least squares in closed form, and a small forest for each shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.cells import bucket
from fieldtally.operators.forest import fit_forest
from fieldtally.operators.train import random_forest
from fieldtally.operators.vote import Vote

# Below this share of the product of the variances the normal equations count as singular.
SINGULAR = 1e-12


def shard_of(key: Column, shards: int, salt: str | int = "shard") -> Column:
    """A shard by hash of the row key; it stands in for the physical partition."""
    return bucket(shards, salt, key)


def _determinant(m: Sequence[Sequence[Column]]) -> Column:
    (a, b, c), (d, e, f), (g, h, i) = m
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def fit_sharded_linear(df: DataFrame, shard: Column, features: Sequence[str], target: str) -> DataFrame:
    """Ordinary least squares with intercept on three features, one row of coefficients per shard.

    One partial aggregate keeps centred moments per shard; the 3×3 system is solved in column
    expressions (Cramer's rule). A singular shard has null coefficients.
    """
    x, y = list(features), target
    if len(x) != 3:
        raise ValueError("three features expected")
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    moments = df.groupBy(shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("my"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.covar_pop(x[i], x[j]).alias(f"s{i}{j}") for i, j in pairs],
        *[F.covar_pop(c, y).alias(f"t{i}") for i, c in enumerate(x)],
    )
    s = [[F.col(f"s{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    t = [F.col(f"t{i}") for i in range(3)]
    det = _determinant(s)
    solvable = F.abs(det) > F.lit(SINGULAR) * s[0][0] * s[1][1] * s[2][2]
    safe = F.when(solvable, det)
    slopes = [
        _determinant([[t[i] if j == k else s[i][j] for j in range(3)] for i in range(3)]) / safe for k in range(3)
    ]
    solved = moments.select("shard", "n", "my", "m0", "m1", "m2", *[b.alias(f"b{k}") for k, b in enumerate(slopes)])
    intercept = F.col("my") - sum((F.col(f"b{k}") * F.col(f"m{k}") for k in range(3)), F.lit(0.0))
    return solved.select("shard", "n", intercept.alias("intercept"), "b0", "b1", "b2")


def mean_linear_prediction(
    df: DataFrame, coefficients: DataFrame, features: Sequence[str], alias: str = "prediction"
) -> DataFrame:
    """Unthresholded mean of all shard models on every row.

    The mean of linear predictions is the prediction of the mean coefficients, so the models come in as one
    scalar row: a projection without join, replication or shuffle of ``df``.
    """
    names = ["intercept", *[f"b{k}" for k in range(len(features))]]
    mean = coefficients.agg(F.struct(*[F.avg(c).alias(c) for c in names]).alias("m")).scalar()
    total = mean["intercept"]
    for k, c in enumerate(features):
        total = total + mean[f"b{k}"] * F.col(c)
    return df.withColumn(alias, total)


def fit_sharded_forest(train: DataFrame, shards: Sequence[int], shard: str = "shard", trees: int = 10, **overrides) -> Vote:
    """One forest for each shard of a cached frame; each fit is distributed over the shard's rows."""
    members = [
        fit_forest(random_forest(**{"numTrees": trees, "maxDepth": 30, **overrides}), train.filter(F.col(shard) == s))
        for s in shards
    ]
    return Vote([f"shard_{s}" for s in shards], members)
