"""Scoring cleaned frames with a model or a vote."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.forest import Forest
from fieldtally.operators.gradient_boost import Boosted
from fieldtally.operators.stumps import Stumps
from fieldtally.operators.vote import OUTPUTS, Vote, threshold


def with_score(model, df: DataFrame) -> DataFrame:
    """Adds ``score`` (probability of class 1 or the vote's mean) and the 0/1 ``prediction``.

    Input columns with the names of a model's outputs are replaced.
    """
    kept = [c for c in df.columns if c not in ("score", "prediction")]
    scored = model.transform(df.drop("score", "prediction", *OUTPUTS))
    if not isinstance(model, Vote | Stumps | Forest | Boosted):
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*[c for c in kept if c not in OUTPUTS], "score").withColumn("prediction", threshold(F.col("score")))


def score_validation(model, cleaned: DataFrame, key: str, label: str = "label") -> DataFrame:
    return with_score(model, cleaned).select(key, label, "score", "prediction")


def score_test(model, cleaned: DataFrame, key: str, *order: str) -> DataFrame:
    """(order columns, key, prediction), unsorted: only the export sorts."""
    return with_score(model, cleaned).select(*order, key, "prediction")
