"""The perceptron's fit by matrix products over blocks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from fieldtally.operators import perceptron, train
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.evaluate import auc_roc
from fieldtally.operators.score import with_score


@pytest.fixture(scope="module")
def planted(spark):
    rows = spark.range(400).select("id", *[(F.pmod(F.hash("id", F.lit(i)), F.lit(10)) / 10.0).alias(f"x{i}") for i in range(3)])
    label = (F.col("x0") * F.col("x1") > 0.2).cast("double").alias("label", metadata=LABEL_META)
    return sparse_vector(rows.select("id", label, F.array("x0", "x1", "x2").alias("v")), "v", 3).drop("v").cache()


def log_loss(model, df):
    p = F.greatest(F.lit(1e-12), F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score")))
    return with_score(model, df).agg(F.avg(-F.log(p))).first()[0]


def test_gradient_is_the_slope_of_the_loss():
    rng, layers = np.random.default_rng(1), [3, 5, 4, 2]
    weights = rng.normal(size=3 * 5 + 5 + 5 * 4 + 4 + 4 * 2 + 2)
    x, label = rng.normal(size=(9, 3)), rng.integers(0, 2, 9).astype(np.int32)
    halves = [pa.RecordBatch.from_arrays([pa.array([label[h].tobytes()]), pa.array([x[h].tobytes()])], names=["label", "x"]) for h in (slice(0, 5), slice(5, 9))]

    def at(w):
        row = next(perceptron._sums(layers, w)(iter(halves)))
        assert row["n"][0].as_py() == 9
        return row["loss"][0].as_py(), np.frombuffer(row["g"][0].as_py())

    _, gradient = at(weights)
    slopes = [(at(weights + d)[0] - at(weights - d)[0]) / 2e-6 for d in np.eye(len(weights)) * 1e-6]
    assert np.allclose(gradient, slopes, atol=1e-5)


def test_steps_find_the_least_of_a_narrow_valley():
    def valley(v):
        a, b = v
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2 + 1.0, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(perceptron.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-12), [1.0, 1.0], atol=1e-4)


def test_the_fit_is_as_good_as_the_library_and_is_saved(planted, tmp_path):
    own = train.fit_kind("mlp", planted, maxIter=60)
    plain = PipelineModel([own.stages[0], train.perceptron(3, featuresCol="scaled", maxIter=60).fit(own.stages[0].transform(planted))])
    assert log_loss(own, planted) <= log_loss(plain, planted) * 1.1 + 0.01
    own.save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    assert auc_roc(with_score(again, planted)) == auc_roc(with_score(own, planted))


def test_the_rows_are_not_read_by_the_library(planted, monkeypatch):
    """Its steps take several times as long; it gives the start and the model, from one row."""
    seen, fit = [], MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, df: seen.append((self.getMaxIter(), df.count())) or fit(self, df))
    train.fit_kind("mlp", planted, maxIter=2)
    assert seen == [(0, 1), (0, 1)]


def test_labels_are_checked(planted):
    with pytest.raises(Exception, match="(?i)labels must"):
        train.fit_kind("mlp", planted.withColumn("label", F.when(F.col("id") > 0, 0.0).alias("label", metadata=LABEL_META)), maxIter=2)


def test_equal_rows_are_one_row_with_a_count(spark, monkeypatch):
    """Before, each row went through the layers in each step, however often it came, in a task for each partition."""
    flags = F.array(*[(F.col("id") % 4 == k).cast("double") for k in range(4)])
    rows = spark.range(20_000, numPartitions=40).select("id", (F.col("id") % 4).isin(1, 2).cast("double").alias("label", metadata=LABEL_META), flags.alias("v"))
    rows = sparse_vector(rows, "v", 4).drop("v")
    seen, loss_of = [], perceptron._loss_of
    monkeypatch.setattr(perceptron, "_loss_of", lambda blocks, layers: seen.append(blocks) or loss_of(blocks, layers))
    held = []
    minimise = perceptron.minimise

    def minimised(loss_at, x, *rest):
        frame = seen[0]
        held.append((frame.rdd.getNumPartitions(), [(len(b.label) // 4, np.frombuffer(b.n).sum()) for b in frame.collect()], loss_at(x)))
        return minimise(loss_at, x, *rest)

    monkeypatch.setattr(perceptron, "minimise", minimised)
    model = train.fit_kind("mlp", rows, maxIter=30)
    assert with_score(model, rows).filter("prediction <> label").count() == 0
    (tasks, blocks, (loss, gradient)), = held
    assert tasks <= spark.sparkContext.defaultParallelism
    assert sum(n for n, _ in blocks) <= 40 * 4 and sum(w for _, w in blocks) == 20_000
    monkeypatch.setattr(perceptron, "FEWER", 0.0)
    seen.clear(), held.clear()
    train.fit_kind("mlp", rows, maxIter=1)
    assert held[0][2][0] == pytest.approx(loss, rel=1e-9) and np.allclose(held[0][2][1], gradient)
