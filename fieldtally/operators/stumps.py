"""Weighted decision stumps as plain numbers: one expression scores them, one small table stores them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE = "round int, feature int, threshold double, left double, right double, weight double"


@dataclass(frozen=True)
class Stump:
    """``left`` for values up to ``threshold``, else ``right``."""

    feature: int
    threshold: float
    left: float
    right: float


def _listed(stumps: list[Stump], weights: list[float]) -> Column:
    """The stumps as one literal array: the plan's depth does not grow with their number."""
    return F.array(
        *[
            F.struct(F.lit(s.feature).alias("f"), F.lit(s.threshold).alias("t"), F.lit(s.left).alias("l"), F.lit(s.right).alias("r"), F.lit(w).alias("w"))
            for s, w in zip(stumps, weights, strict=True)
        ]
    )


def _sum(values: Column, listed: Column) -> Column:
    """Sum of the answers of the stumps, each times its weight."""

    def add(total: Column, s: Column) -> Column:
        return total + s["w"] * F.when(F.get(values, s["f"]) <= s["t"], s["l"]).otherwise(s["r"])

    return F.aggregate(listed, F.lit(0.0), add)


@dataclass
class Stumps:
    """A weighted vote of stumps over the vector column ``features``."""

    stumps: list[Stump]
    weights: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, the weighted mean answer, and ``prediction``."""
        values = F.col("__values")
        score = _sum(values, _listed(self.stumps, self.weights)) / F.lit(float(sum(self.weights)))
        scored = df.withColumn("__values", vector_to_array("features")).select(*df.columns, score.alias("score"))
        return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, s.feature, s.threshold, s.left, s.right, w) for i, (s, w) in enumerate(zip(self.stumps, self.weights, strict=True))]
        spark.createDataFrame(rows, TABLE).coalesce(1).write.mode("overwrite").parquet(f"{path}/stumps")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Stumps:
        rows = spark.read.schema(TABLE).parquet(f"{path}/stumps").orderBy("round").collect()  # one row per round
        return cls([Stump(r.feature, r.threshold, r.left, r.right) for r in rows], [r.weight for r in rows])
