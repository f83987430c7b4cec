"""Ensembles: weighted mean of member predictions against a threshold; saved as a folder per member."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.forest import Forest
from fieldtally.operators.gradient_boost import Boosted
from fieldtally.operators.stumps import Stumps

OUTPUTS = ("rawPrediction", "probability", "prediction")
MANIFEST = "member string, kind string, weight double, path string"


def threshold(score: Column, cut: float = 0.5) -> Column:
    """Score above ``cut`` → 1, else 0."""
    return F.when(score > F.lit(cut), F.lit(1)).otherwise(F.lit(0))


def mean_score(predictions: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    weights = weights or [1.0] * len(predictions)
    terms = [p.cast("double") * F.lit(float(w)) for p, w in zip(predictions, weights, strict=True)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total / F.lit(float(sum(weights)))


def vote(predictions: Sequence[Column], weights: Sequence[float] | None = None, cut: float = 0.5) -> Column:
    return threshold(mean_score(predictions, weights), cut)


@dataclass
class Vote:
    """Fitted members. ``transform`` is a JVM projection; members reach the tasks inside the plan."""

    names: list[str]
    members: list[PipelineModel | Vote | Stumps | Forest | Boosted]
    weights: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.weights = self.weights or [1.0] * len(self.members)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` and ``prediction``."""
        columns, scored, answers = list(df.columns), df, []
        for i, member in enumerate(self.members):
            # A vote can be a member of a vote: the column count keeps the names of the levels apart.
            answer = f"_answer{len(columns)}_{i}"
            scored = member.transform(scored).select(
                *columns, *answers, F.col("prediction").cast("double").alias(answer)
            )
            answers.append(answer)
        score = mean_score([F.col(a) for a in answers], self.weights)
        return scored.select(*columns, score.alias("score")).withColumn(
            "prediction", threshold(F.col("score")).cast("double")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        rows = []
        for i, (name, member, weight) in enumerate(zip(self.names, self.members, self.weights, strict=True)):
            where = f"member-{i:04d}"  # within the folder, which may be moved
            if isinstance(member, Vote | Stumps | Forest | Boosted):
                member.save(spark, f"{path}/{where}")
            else:
                member.write().overwrite().save(f"{path}/{where}")
            rows.append((name, KINDS.get(type(member), "model"), float(weight), where))
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")

    @classmethod
    def manifest(cls, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Vote:
        # One row per member.
        rows = cls.manifest(spark, path).orderBy("path").collect()
        places = [f"{path}/{r['path']}" for r in rows]
        load = {"vote": lambda p: cls.load(spark, p), "stumps": lambda p: Stumps.load(spark, p), "forest": lambda p: Forest.load(spark, p), "boosted": lambda p: Boosted.load(spark, p), "model": PipelineModel.load}
        members = [load[r["kind"]](p) for r, p in zip(rows, places, strict=True)]
        return cls([r["member"] for r in rows], members, [r["weight"] for r in rows])


KINDS = {Vote: "vote", Stumps: "stumps", Forest: "forest", Boosted: "boosted"}
