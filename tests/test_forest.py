"""Forests of which the driver holds the upper nodes only."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fieldtally.operators import forest, shards, train
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.order import cache_input
from fieldtally.operators.score import with_score
from fieldtally.operators.vote import Vote


@pytest.fixture(scope="module")
def noisy(spark):
    """A label that two of four features decide, but for every eleventh row."""
    columns = [(F.pmod(F.hash("id", F.lit(i)), F.lit(100)) / 100.0).alias(f"x{i}") for i in range(4)]
    rows = spark.range(3000).select("id", *columns)
    label = ((F.col("x0") + F.col("x1") > 1.0) != (F.col("id") % 11 == 0)).cast("double")
    rows = rows.select("id", label.alias("label", metadata=LABEL_META), F.array(*[f"x{i}" for i in range(4)]).alias("v"))
    return cache_input(sparse_vector(rows, "v", 4).drop("v"))


def scores(model, df):
    return {r.id: (r.score, r.prediction) for r in with_score(model, df).select("id", "score", "prediction").collect()}


@pytest.mark.parametrize("rows", [1 << 16, 200])
def test_depth_is_not_cut_and_leaves_stay_out_of_the_driver(spark, noisy, monkeypatch, rows):
    monkeypatch.setattr(forest, "NODE_ROWS", rows)
    model = train.fit_kind("weighted_forest", noisy)
    assert not isinstance(model, PipelineModel)  # which holds every node in the driver
    total = model.branches.agg(F.sum("nodes")).first()[0]
    assert total > 15 * 300 and len(model.upper.feature) < 15 * 2 * 3000 * 2 / rows + 31
    plain = PipelineModel([train.weighted_forest().fit(train.with_class_weight(noisy))])
    label = {r.id: r.label for r in noisy.select("id", "label").collect()}
    own, theirs = [np.mean([p == label[i] for i, (_, p) in scores(m, noisy).items()]) for m in (model, plain)]
    assert own == pytest.approx(theirs, abs=0.02)


def test_one_tree_on_all_features_equals_the_library(noisy):
    rows = noisy.filter("id % 11 <> 0").withColumn("shard", F.lit(0))
    model = shards.fit_sharded_forest(rows, [0], trees=1, maxDepth=4, maxBins=128, bootstrap=False)
    plain = PipelineModel([train.random_forest(numTrees=1, maxDepth=4, maxBins=128, bootstrap=False).fit(rows)])
    own, theirs = scores(model.members[0], rows), scores(plain, rows)
    differ = [i for i in own if abs(own[i][0] - theirs[i][0]) > 1e-9]
    assert len(differ) < len(own) * 0.02  # cuts lie half-way between values there, too; equal gains may fall elsewhere


def test_shuffled_scores_equal_broadcast_ones(noisy, monkeypatch):
    monkeypatch.setattr(forest, "NODE_ROWS", 300)
    model = train.fit_kind("weighted_forest", noisy, numTrees=4)
    here = scores(model, noisy.union(noisy.withColumn("id", F.col("id") + 10_000)))
    monkeypatch.setattr(forest, "SMALL_NODES", 0)
    monkeypatch.setattr(forest, "SCORED_ROWS", 20)
    assert scores(model, noisy.union(noisy.withColumn("id", F.col("id") + 10_000))) == here


def test_saved_forests_score_alike(spark, noisy, tmp_path):
    model = Vote(["a", "b"], [train.fit_kind("weighted_forest", noisy, numTrees=2), train.fit_kind("logistic_l1", noisy)])
    model.save(spark, f"{tmp_path}/vote")
    assert scores(Vote.load(spark, f"{tmp_path}/vote"), noisy) == scores(model, noisy)


def test_odd_rows(spark, noisy):
    with pytest.raises(ValueError, match="no rows"):
        train.fit_kind("weighted_forest", noisy.limit(0))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        train.fit_kind("weighted_forest", noisy.withColumn("label", F.lit(None).cast("double")))
    constant = noisy.withColumn("label", F.lit(1.0))
    assert {p for _, p in scores(train.fit_kind("weighted_forest", constant), noisy).values()} == {1}


def test_many_rows_of_a_few_values(spark):
    """More rows than the sample of the cuts, which must not take or leave all rows of a value."""
    flags = F.array(*[(F.col("id") % 4 == k).cast("double") for k in range(4)])
    rows = spark.range(120_000).select("id", (F.col("id") % 4).isin(1, 2).cast("double").alias("label", metadata=LABEL_META), flags.alias("v"))
    rows = sparse_vector(rows, "v", 4).drop("v")
    model = train.fit_kind("weighted_forest", rows, numTrees=9)
    assert with_score(model, rows).filter("prediction <> label").count() == 0


def test_a_node_that_cannot_be_split_sends_no_rows(spark, monkeypatch):
    """Before, all rows of a large node of one label went to one task."""
    columns = [(F.pmod(F.hash("id", F.lit(i)), F.lit(1000)) / 1000.0).alias(f"x{i}") for i in range(4)]
    rows = spark.range(4000).select("id", *columns).select("id", (F.col("x0") > 0.5).cast("double").alias("label", metadata=LABEL_META), F.array(*[f"x{i}" for i in range(4)]).alias("v"))
    rows = cache_input(sparse_vector(rows, "v", 4).drop("v"))
    monkeypatch.setattr(forest, "NODE_ROWS", 200)
    grown = forest._grown

    def checked(p, branches):
        own = grown(p, branches)

        def run(pieces):
            held = sum(len(k) for k in pieces["kinds"].to_pylist())
            if held > 300:
                raise ValueError(f"{held} rows in one task")
            return own(pieces)

        return run

    monkeypatch.setattr(forest, "_grown", checked)
    model = shards.fit_sharded_forest(rows.withColumn("shard", F.lit(0)), [0], trees=3).members[0]
    assert sum(r.nodes for r in model.branches.select("nodes").collect()) > 3
    assert with_score(model, rows).filter("prediction <> label").count() < 200  # within a bin of the cut


@pytest.mark.parametrize("bootstrap", [True, False])
def test_equal_rows_are_one_row_with_a_count(spark, monkeypatch, bootstrap):
    """Before, each row went to the trees by itself, however often its bins and label came."""
    monkeypatch.setattr(forest, "NODE_ROWS", 500)
    rows = spark.range(20_000, numPartitions=4).select("id", (F.col("id") % 4).cast("double").alias("a"), F.floor(F.col("id") / 4).alias("b"))
    label = (F.pmod(F.hash("id"), F.lit(100)) < F.col("a") * 10 + F.when(F.col("a") > 1, 55).otherwise(5)).cast("double").alias("label", metadata=LABEL_META)
    rows = rows.select("id", label, F.col("a"), F.array(F.col("a"), (F.col("b") % 3).cast("double")).alias("v"))
    rows = cache_input(sparse_vector(rows, "v", 2).drop("v"))
    seen, opened = [], forest._grow_upper
    monkeypatch.setattr(forest, "_grow_upper", lambda blocks, p, n: seen.append((n, blocks)) or opened(blocks, p, n))
    model = train.fit_kind("weighted_forest", rows, numTrees=5, maxDepth=1, bootstrap=bootstrap, subsamplingRate=0.5)
    (stored, blocks), = seen
    assert stored <= 4 * 24
    counted = [np.frombuffer(r.n).sum() for r in blocks.select("n").collect()]
    assert sum(counted) == 20_000
    monkeypatch.setattr(forest, "NODE_ROWS", 1 << 16)
    plain = train.fit_kind("weighted_forest", rows, numTrees=5, maxDepth=1, bootstrap=bootstrap, subsamplingRate=0.5)  # of rows by themselves
    own, theirs = ({r.a: r.s for r in with_score(m, rows).groupBy("a").agg(F.avg("score").alias("s")).collect()} for m in (model, plain))
    assert own == pytest.approx(theirs, abs=0.03)


def test_unlike_rows_never_meet():
    from fieldtally.operators.equal_rows import equal_rows

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3, 500).astype("u1"), rng.integers(0, 4, (500, 2)).astype("<u2")
    first, group = equal_rows([a, b])
    keys = [(int(x), *map(int, y)) for x, y in zip(a, b, strict=True)]
    assert len(first) == len(set(keys)) and all(keys[first[g]] == k for g, k in zip(group, keys, strict=True))
    assert equal_rows([np.arange(500)]) is None


def test_a_combination_of_bins_is_scored_once(noisy, monkeypatch):
    """Before, each row went down all trees; the answers are the same."""
    model = train.fit_kind("weighted_forest", noisy.withColumn("features", noisy["features"]), numTrees=3, maxBins=8)
    once = scores(model, noisy)
    monkeypatch.setattr(forest, "SCORED_CELLS", 0)
    assert scores(model, noisy) == once
    met, descend = [], forest._descend
    monkeypatch.setattr(forest, "SCORED_CELLS", 1 << 20)
    monkeypatch.setattr(forest, "_descend", lambda codes, *rest: met.append(len(codes)) or descend(codes, *rest))
    columns = noisy.limit(50).unionByName(noisy.limit(50)).toPandas()
    kept = {}

    class Frame:
        """Takes the function that scores, to call it here."""

        def withColumn(self, name, column):
            return self

    monkeypatch.setattr(forest.F, "arrow_udf", lambda f, kind: kept.setdefault("scores", f) and (lambda c: c))
    model._by_broadcast(Frame())
    values = forest.pa.array([v.toArray() for v in columns["features"]])
    first, again = (kept["scores"](values).to_pylist() for _ in range(2))
    assert first == again and len(met) == 3 and met[0] <= 50
