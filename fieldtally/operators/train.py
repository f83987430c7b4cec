"""Classifiers with the documented parameters. Every fit runs distributed in ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from fieldtally.operators.boost import fit_adaboost
from fieldtally.operators.forest import Forest, fit_forest
from fieldtally.operators.gradient_boost import Boosted, fit_boosted
from fieldtally.operators.perceptron import fit_perceptron
from fieldtally.operators.stumps import Stumps
from fieldtally.operators.vote import Vote

# Training parameters.
CLASS_WEIGHTS = {1.0: 0.7, 0.0: 0.3}
HIDDEN_LAYERS = (200, 50, 20)
ENSEMBLE = ("mlp", "weighted_forest", "gbt", "weak_l2", "adaboost")
ENSEMBLE_SIZE = 3
TOGETHER = 2  # members in fitting: each caches the rows in a form of its own


def logistic_l1(**overrides) -> LogisticRegression:
    """L1 logistic regression without intercept."""
    params = dict(regParam=0.005, elasticNetParam=1.0, fitIntercept=False, maxIter=100, tol=1e-6)
    return LogisticRegression(**{**params, **overrides})


def random_forest(**overrides) -> RandomForestClassifier:
    params = dict(numTrees=15, maxDepth=9, maxBins=32, impurity="gini", featureSubsetStrategy="auto", seed=42)
    return RandomForestClassifier(**{**params, **overrides})


def deep_forest(**overrides) -> RandomForestClassifier:
    return random_forest(**{"numTrees": 8, "maxDepth": 15, **overrides})


def logistic_weak_l2(rows: int, c: float = 1e5, **overrides) -> LogisticRegression:
    """L2 with inverse strength ``c`` on the summed loss, i.e. 1/(c·rows) on the mean loss."""
    params = dict(regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0, standardization=False, maxIter=100)
    return LogisticRegression(**{**params, **overrides})


def weighted_forest(**overrides) -> RandomForestClassifier:
    """Expects the class weight in column ``weight``; see ``with_class_weight``."""
    params = dict(numTrees=15, maxDepth=25, maxBins=32, impurity="gini", weightCol="weight", seed=42)
    return RandomForestClassifier(**{**params, **overrides})


def gradient_boosted(**overrides) -> GBTClassifier:
    params = dict(maxIter=100, maxDepth=5, stepSize=0.1, minInstancesPerNode=500, featureSubsetStrategy="sqrt", seed=42)
    return GBTClassifier(**{**params, **overrides})


def perceptron(width: int, **overrides) -> MultilayerPerceptronClassifier:
    params = dict(layers=[width, *HIDDEN_LAYERS, 2], solver="l-bfgs", maxIter=200, seed=42)
    return MultilayerPerceptronClassifier(**{**params, **overrides})


def with_class_weight(df: DataFrame, label: str = "label", alias: str = "weight") -> DataFrame:
    by_label = F.when(F.col(label) == 1.0, F.lit(CLASS_WEIGHTS[1.0])).otherwise(F.lit(CLASS_WEIGHTS[0.0]))
    return df.withColumn(alias, by_label)


def fit(estimator: Estimator, train: DataFrame) -> PipelineModel:
    """Fit and wrap, so every model saves and loads the same way."""
    return PipelineModel([estimator.fit(train)])


def _weighted(train: DataFrame, overrides: dict) -> Forest:
    return fit_forest(weighted_forest(**overrides), with_class_weight(train))


def _weak_l2(train: DataFrame, overrides: dict) -> PipelineModel:
    return fit(logistic_weak_l2(train.count(), **overrides), train)


def _mlp(train: DataFrame, overrides: dict) -> PipelineModel:
    """Scaled to unit deviation first: positions and counts differ by orders of magnitude."""
    width = train.schema["features"].metadata["ml_attr"]["num_attrs"]
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled")
    fitted = scaler.fit(train)
    return PipelineModel([fitted, fit_perceptron(perceptron(width, featuresCol="scaled", **overrides), fitted.transform(train))])


KINDS: dict[str, Callable[[DataFrame, dict], PipelineModel | Vote | Stumps | Forest | Boosted]] = {
    "logistic_l1": lambda train, o: fit(logistic_l1(**o), train),
    "random_forest": lambda train, o: fit(random_forest(**o), train),
    "deep_forest": lambda train, o: fit(deep_forest(**o), train),
    "weak_l2": _weak_l2,
    "weighted_forest": _weighted,
    "gbt": lambda train, o: fit_boosted(gradient_boosted(**o), train),
    "mlp": _mlp,
    "adaboost": lambda train, o: fit_adaboost(train, **o),
}


def fit_kind(kind: str, train: DataFrame, **overrides) -> PipelineModel | Vote | Stumps | Forest | Boosted:
    """Fit one kind on a frame with ``label`` and ``features``; ``overrides`` replace default parameters."""
    return KINDS[kind](train, overrides)


def fit_ensemble(train: DataFrame, kinds: tuple[str, ...] = ENSEMBLE[:ENSEMBLE_SIZE],
                 overrides: dict[str, dict] | None = None) -> Vote:
    """Members fitted ``TOGETHER`` at a time, each on all rows of the same cached frame.

    The rows are neither copied per member nor gathered per member in a task. A fit is a long row of short jobs, between which the
    executors wait for the driver: another member's jobs run there.
    """
    overrides, spark = overrides or {}, train.sparkSession

    def fitting(kind: str) -> Callable:
        return inheritable_thread_target(spark)(lambda: fit_kind(kind, train, **overrides.get(kind, {})))

    with ThreadPoolExecutor(TOGETHER) as pool:
        members = list(pool.map(lambda fitted: fitted(), [fitting(kind) for kind in kinds]))
    return Vote([f"{i}_{kind}" for i, kind in enumerate(kinds)], members)
