"""Boosted trees over binned rows, in which equal rows are one."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from fieldtally.operators import train
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.score import with_score
from fieldtally.operators.vote import Vote

ALL = {"maxIter": 7, "maxDepth": 3, "minInstancesPerNode": 5, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def steps(spark):
    """Features of ten values each, so that both find the same cuts."""
    rows = spark.range(900).select("id", *[(F.pmod(F.hash("id", F.lit(i)), F.lit(10)) / 10.0).alias(f"x{i}") for i in range(3)])
    label = ((F.col("x0") + F.col("x1") > 0.9) != (F.pmod(F.hash("id"), F.lit(13)) == 0)).cast("double")
    rows = rows.select("id", label.alias("label", metadata=LABEL_META), F.array("x0", "x1", "x2").alias("v"))
    return sparse_vector(rows, "v", 3).drop("v").cache()


def scores(model, df):
    return {r.id: r.score for r in with_score(model, df).select("id", "score").collect()}


def test_scores_equal_the_library(steps):
    own = scores(train.fit_kind("gbt", steps, **ALL), steps)
    plain = scores(PipelineModel([train.gradient_boosted(**ALL).fit(steps)]), steps)
    close = [abs(own[i] - plain[i]) < 1e-6 for i in own]
    assert len(own) == 900 and np.mean(close) > 0.95  # equal gains may fall on another feature


def test_equal_rows_count_each_time(steps):
    twice = train.fit_kind("gbt", steps.union(steps), **{**ALL, "minInstancesPerNode": 10})
    once = train.fit_kind("gbt", steps, **ALL)
    a, b = scores(once, steps), scores(twice, steps)
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_the_library_does_not_fit(steps, monkeypatch):
    """It writes and reads all rows for each tree."""
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: pytest.fail("fitted by the library"))
    train.fit_kind("gbt", steps, maxIter=1)


def test_saved_trees_score_alike(spark, steps, tmp_path):
    model = Vote(["gbt"], [train.fit_kind("gbt", steps, **ALL)])
    model.save(spark, f"{tmp_path}/vote")
    assert scores(Vote.load(spark, f"{tmp_path}/vote"), steps) == scores(model, steps)


def test_odd_rows(steps):
    with pytest.raises(ValueError, match="no rows"):
        train.fit_kind("gbt", steps.limit(0))
    constant = train.fit_kind("gbt", steps.withColumn("label", F.lit(0.0)), maxIter=2)
    assert max(scores(constant, steps).values()) < 0.5


def test_many_rows_of_a_few_values(spark):
    """More rows than the sample of the cuts, which must not take or leave all rows of a value."""
    flags = F.array(*[(F.col("id") % 4 == k).cast("double") for k in range(4)])
    rows = spark.range(120_000).select("id", (F.col("id") % 4).isin(1, 2).cast("double").alias("label", metadata=LABEL_META), flags.alias("v"))
    rows = sparse_vector(rows, "v", 4).drop("v")
    model = train.fit_kind("gbt", rows, maxIter=9)
    assert with_score(model, rows).filter("prediction <> label").count() == 0
