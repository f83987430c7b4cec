"""Whether fitted logistic coefficients are optimal, from one aggregate over all rows.

The loss is convex, so coefficients are optimal if and only if no direction lowers it: the gradient of the mean loss answers the penalty at
every coefficient that is not 0, and stays within the L1 penalty at every one that is. Nothing is taken from the trainer but the
coefficients; probabilities are computed anew from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.profile import array_state


def residual_state(df: DataFrame, coefficients: Sequence[float], intercept: float, label: str = "label", features: str = "features") -> DataFrame:
    """The moments of every feature beside the residual, probability less label; one aggregate."""
    rows = df.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    weights = F.array(*[F.lit(float(b)) for b in coefficients])
    margin = F.aggregate(F.zip_with("x", weights, lambda v, b: v * b), F.lit(float(intercept)), lambda total, v: total + v)
    residual = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("y")
    return array_state(rows.select("x", residual.alias("residual")), "x", len(coefficients), "residual")


def certificate(
    df: DataFrame,
    coefficients: Sequence[float],
    intercept: float,
    l1: float = 0.0,
    l2: float = 0.0,
    standardized: bool = True,
    fit_intercept: bool = True,
    tolerance: float = 1e-3,
    label: str = "label",
    features: str = "features",
) -> DataFrame:
    """(pos, n, coefficient, slope, violation, optimal), a row for each coefficient and, at −1, for a fitted intercept.

    ``slope`` is the loss's slope along the feature in units of its deviation, so that no feature's scale matters, and ``violation`` by how
    much it misses the condition. ``l1`` and ``l2`` weigh the absolute value and half the square of the coefficients, which are
    taken in units of deviation if ``standardized``. A feature without variance has to have coefficient 0.
    """
    state = residual_state(df, coefficients, intercept, label, features)
    b = F.get(F.array(*[F.lit(float(v)) for v in coefficients]), F.col("pos"))
    deviation = F.sqrt(F.col("m2") / (F.col("n") - 1))
    named = state.select("pos", "n", "mean", "co", "y_mean", b.alias("coefficient"), F.when(F.col("n") > 1, deviation).alias("deviation"))
    varies, unit = F.col("deviation") > 0, F.when(F.col("deviation") > 0, F.col("deviation"))
    gradient = F.col("co") / F.col("n") + F.col("mean") * F.col("y_mean")
    pull = F.col("coefficient") * unit if standardized else F.col("coefficient") / unit
    bound = F.lit(l1) if standardized else F.lit(l1) / unit
    slope = gradient / unit + F.lit(l2) * pull
    missed = (
        F.when(~varies | F.col("deviation").isNull(), F.abs("coefficient"))
        .when(F.col("coefficient") != 0, F.abs(slope + F.signum("coefficient") * bound))
        .otherwise(F.greatest(F.lit(0.0), F.abs(slope) - bound))
    )
    checked = named.select("pos", "n", "coefficient", slope.alias("slope"), missed.alias("violation"))
    if fit_intercept:  # the residuals of all rows
        own = named.agg(F.max("n").alias("n"), F.max("y_mean").alias("slope")).select(
            F.lit(-1).alias("pos"), "n", F.lit(float(intercept)).alias("coefficient"), "slope", F.abs("slope").alias("violation")
        )
        checked = checked.unionByName(own)
    return checked.withColumn("optimal", F.col("violation") <= F.lit(tolerance))
