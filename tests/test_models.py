import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.operators import shards, train, vote
from fieldtally.operators.boost import fit_adaboost
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.evaluate import confusion_accuracy
from fieldtally.operators.order import cache_input
from fieldtally.operators.score import with_score
from fieldtally.operators.vote import Vote

QUICK = {"gbt": {"maxIter": 3, "minInstancesPerNode": 5}, "adaboost": {"rounds": 3}, "mlp": {"maxIter": 40}, "weighted_forest": {"maxDepth": 6}}


@pytest.fixture(scope="module")
def planted(spark):
    """A label that three of six features decide."""
    columns = [(F.pmod(F.hash("id", F.lit(i)), F.lit(10)) / 10.0).alias(f"x{i}") for i in range(6)]
    rows = spark.range(1500).repartition(4).select("id", *columns)
    label = F.when(F.col("x0") + F.col("x1") - F.col("x2") > 0.45, 1.0).otherwise(0.0)
    rows = rows.select("id", label.alias("label", metadata=LABEL_META), F.array(*[f"x{i}" for i in range(6)]).alias("v"))
    return cache_input(sparse_vector(rows, "v", 6).drop("v"))


def accuracy(model, df):
    return confusion_accuracy(with_score(model, df)).first().accuracy


@pytest.mark.parametrize("kind", sorted(train.KINDS))
def test_kinds_learn(spark, planted, kind):
    model = train.fit_kind(kind, planted, **QUICK.get(kind, {}))
    base = planted.agg(F.avg("label")).first()[0]
    got = accuracy(model, planted)
    assert got >= max(base, 1 - base) + (0.0 if kind == "logistic_l1" else 0.05)


def test_defaults():
    from fieldtally.operators import boost

    assert train.logistic_l1().getRegParam() == 0.005 and not train.logistic_l1().getFitIntercept()
    forest = train.random_forest()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins(), forest.getSeed()) == (15, 9, 32, 42)
    assert (train.deep_forest().getNumTrees(), train.deep_forest().getMaxDepth()) == (8, 15)
    gbt = train.gradient_boosted()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getMinInstancesPerNode()) == (100, 5, 0.1, 500)
    assert train.perceptron(7).getLayers() == [7, 200, 50, 20, 2]
    assert train.logistic_weak_l2(1000).getRegParam() == pytest.approx(1e-8)
    assert (boost.ROUNDS, boost.LEARNING_RATE) == (100, 0.9)


def samme(x, y, rounds, rate):
    """Brute force over all stumps and cuts."""
    w, errors = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        best = None
        for j in range(x.shape[1]):
            for cut in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= cut
                guess = np.where(left, *(float(w[m & (y == 1)].sum() > w[m & (y == 0)].sum()) for m in (left, ~left)))
                def gini(m):
                    t = w[m].sum()
                    q = w[m & (y == 1)].sum() / t
                    return t * 2 * q * (1 - q)
                impurity = gini(left) + gini(~left)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, guess)
        miss = best[1] != y
        err = w[miss].sum() / w.sum()
        errors.append(err)
        w = w * np.exp(rate * np.log((1 - err) / err) * miss)
        w /= w.sum()
    return errors


def test_adaboost_weights_and_errors(planted):
    history = []
    model = fit_adaboost(planted, rounds=5, history=history)
    assert all(h["total"] == pytest.approx(1.0) for h in history)
    assert all(0 < h["error"] < 0.5 for h in history)
    pdf = planted.toPandas()
    x = np.array([v.toArray() for v in pdf.features])
    assert [h["error"] for h in history] == pytest.approx(samme(x, pdf.label.to_numpy(), 5, 0.9), abs=1e-9)
    assert model.weights == pytest.approx([h["alpha"] for h in history])


def test_adaboost_stops_on_a_perfect_stump(spark):
    rows = spark.range(40).select((F.col("id") >= 20).cast("double").alias("label", metadata=LABEL_META), F.array(F.col("id").cast("double")).alias("v"))
    model = fit_adaboost(sparse_vector(rows, "v", 1), rounds=10)
    assert len(model.stumps) == 1 and accuracy(model, sparse_vector(rows, "v", 1)) == 1.0


def test_vote_saves_and_loads(spark, planted, tmp_path):
    model = train.fit_ensemble(planted, ("logistic_l1", "adaboost"), QUICK)
    model.save(spark, str(tmp_path / "vote"))
    loaded = Vote.load(spark, str(tmp_path / "vote"))
    assert loaded.names == model.names and loaded.weights == model.weights
    a = {r.id: r.score for r in model.transform(planted).collect()}
    b = {r.id: r.score for r in loaded.transform(planted).collect()}
    assert a == b
    kinds = [r.kind for r in Vote.manifest(spark, str(tmp_path / "vote")).orderBy("path").collect()]
    assert kinds == ["model", "stumps"]


def test_vote_arithmetic(spark):
    rows = spark.createDataFrame([(0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 0, 0)], "a int, b int, c int")
    got = rows.select(vote.vote([F.col(c) for c in "abc"])).collect()
    assert [r[0] for r in got] == [0, 1, 1, 0]
    assert rows.limit(1).select(vote.vote([F.col(c) for c in "abc"], [1.0, 1.0, 2.0])).first()[0] == 0


def test_sharded_linear_equals_least_squares(spark, sf):
    from fieldtally.queries.tables import obs

    rows = obs(spark, sf)
    got = {r.shard: r for r in shards.fit_sharded_linear(rows, F.col("event_id") % 4, ["lat", "lon", "month"], "value").collect()}
    pdf = rows.select("event_id", "lat", "lon", "month", "value").toPandas()
    for shard, part in pdf.groupby(pdf.event_id % 4):
        x = np.column_stack([np.ones(len(part)), part[["lat", "lon", "month"]]])
        want = np.linalg.lstsq(x, part["value"], rcond=None)[0]
        assert [got[shard].intercept, got[shard].b0, got[shard].b1, got[shard].b2] == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_published_slopes(spark, sf_centi):
    from fieldtally.queries.tables import obs

    fit = shards.fit_sharded_linear(obs(spark, sf_centi), F.col("event_id") % 4, ["lat", "lon", "month"], "value")
    slopes = [round(r.b0, 6) for r in fit.orderBy("shard").collect()]
    assert slopes == [-0.003258, -0.008244, -0.005795, -0.018795]


def test_singular_shard(spark):
    rows = spark.range(20).select((F.col("id") % 2).alias("s"), F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.col("id").cast("double").alias("c"), F.rand(1).alias("y"))
    assert all(r.intercept is None and r.n == 10 for r in shards.fit_sharded_linear(rows, F.col("s"), ["a", "b", "c"], "y").collect())


def test_mean_prediction_is_the_mean_of_predictions(spark):
    rows = spark.range(50).select("id", *[(F.hash("id", F.lit(i)) % 10).cast("double").alias(f"x{i}") for i in range(3)], F.rand(4).alias("y"))
    fitted = cache_input(shards.fit_sharded_linear(rows, shards.shard_of(F.col("id"), 2), ["x0", "x1", "x2"], "y"))
    got = {r.id: r.prediction for r in shards.mean_linear_prediction(rows, fitted, ["x0", "x1", "x2"]).collect()}
    models = fitted.collect()
    for r in rows.collect():
        each = [m.intercept + m.b0 * r.x0 + m.b1 * r.x1 + m.b2 * r.x2 for m in models]
        assert got[r.id] == pytest.approx(np.mean(each))


def test_sharded_forest(spark, planted):
    sharded = planted.withColumn("shard", shards.shard_of(F.col("id"), 2))
    model = shards.fit_sharded_forest(sharded, [0, 1], trees=5)
    assert len(model.members) == 2 and accuracy(model, planted) > 0.8


def test_an_input_column_called_score_is_not_the_score(planted):
    model = train.fit_kind("logistic_l1", planted)
    plain = {r.id: r.score for r in with_score(model, planted).collect()}
    odd = planted.withColumns({"score": F.lit(7.0), "prediction": F.lit(7.0), "probability": F.lit("p")})
    assert {r.id: r.score for r in with_score(model, odd).collect()} == plain


def test_an_ensemble_can_be_moved(spark, planted, tmp_path):
    import shutil

    model = train.fit_ensemble(planted, ("logistic_l1", "adaboost"), QUICK)
    model.save(spark, str(tmp_path / "here"))
    shutil.copytree(tmp_path / "here", tmp_path / "there")
    assert "here" not in "".join(r.path for r in Vote.manifest(spark, str(tmp_path / "there")).collect())
    scores = [{r.id: r.score for r in m.transform(planted).collect()} for m in (model, Vote.load(spark, str(tmp_path / "there")))]
    assert scores[0] == scores[1]


def test_perceptron_learns(planted):
    from fieldtally.operators.evaluate import auc_roc

    assert auc_roc(with_score(train.fit_kind("mlp", planted, maxIter=40), planted)) > 0.9
