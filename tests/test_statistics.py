import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.operators import correlate, evaluate
from fieldtally.operators import engineer as e
from fieldtally.operators import order as o
from fieldtally.operators import profile as p
from fieldtally.queries.tables import obs

SERIES = [(1.0, 11.0), (2.0, 22.0), (3.0, 33.0), (3.0, 33.0), (5.0, 555.0)]


def test_two_series(spark):
    rows = spark.createDataFrame(SERIES, "x double, y double")
    assert correlate.corr_series(rows, "x", "y").first().r == pytest.approx(0.8500286768773)
    spearman = {(r.i, r.j): r.r for r in correlate.spearman_matrix(rows, ["x", "y"]).collect()}
    assert spearman["x", "y"] == pytest.approx(1.0)


def test_matrix_rows(spark):
    data = [(1.0, 10.0, 100.0), (2.0, 20.0, 200.0), (5.0, 33.0, 366.0)]
    rows = spark.createDataFrame(data, "a double, b double, c double")
    want = np.corrcoef(np.array(data).T)
    named = {(r.i, r.j): r.r for r in correlate.corr_matrix(rows, ["a", "b", "c"]).collect()}
    vector = e.sparse_vector(rows.select(F.array("a", "b", "c").alias("v")), "v", 3)
    by_position = {(r.i, r.j): r.r for r in correlate.corr_matrix_vector(vector).collect()}
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert named[a, b] == pytest.approx(want[i, j])
            assert by_position[i, j] == pytest.approx(want[i, j])


def test_edges_of_correlation(spark):
    rows = spark.createDataFrame([(1.0, 2.0, -1.0, 7.0), (3.0, 6.0, -3.0, 7.0)], "y double, up double, down double, flat double")
    found = {r.name: r.r for r in correlate.corr_target(rows, "y", ["up", "down", "flat"]).collect()}
    assert found["up"] == pytest.approx(1) and found["down"] == pytest.approx(-1) and found["flat"] is None
    arrays = rows.select("y", F.array("up", "down", "flat").alias("v"))
    found = {r.pos: r.r for r in correlate.corr_target_array(arrays, "y", "v", 3).collect()}
    assert found[0] == pytest.approx(1) and found[1] == pytest.approx(-1) and found[2] is None


def matrix_rows(spark, offset=0.0, nulls=False):
    """Ten related columns, some sparse; optionally far from 0, or with nulls."""
    columns = [f"c{i}" for i in range(10)]
    cell = [F.pmod(F.hash("id", F.lit(i)), F.lit(17)) * (F.col("id") % (i + 1) == 0).cast("int") for i in range(10)]
    values = [(c + F.pmod(F.hash("id"), F.lit(5))).cast("double") / 1000 + F.lit(offset) for c in cell]
    if nulls:
        values = [F.when(F.pmod(F.hash("id", F.lit(90 + i)), F.lit(9)) > 0, v) for i, v in enumerate(values)]
    return spark.range(400).select(*[v.alias(c) for v, c in zip(values, columns, strict=True)]), columns


@pytest.mark.parametrize("offset", [0.0, 1e6])
@pytest.mark.parametrize("nulls", [False, True])
def test_matrix_is_right_with_offsets_and_nulls(spark, offset, nulls):
    rows, columns = matrix_rows(spark, offset, nulls)
    found = {(r.i, r.j): r.r for r in correlate.corr_matrix(rows, columns).collect()}
    expected = (rows.dropna().toPandas() - offset).corr()
    assert len(found) == len(columns) ** 2
    assert all(found[i, j] == pytest.approx(expected.loc[i, j], abs=1e-6 if offset else 1e-9) for i, j in found)
    ranks = {(r.i, r.j): r.r for r in correlate.spearman_matrix(rows, columns[:4]).collect()}
    expected = rows.select(*columns[:4]).dropna().toPandas().corr("spearman")
    assert all(ranks[i, j] == pytest.approx(expected.loc[i, j], abs=1e-9) for i, j in ranks)


def test_layout_of_the_rows_does_not_matter(spark):
    from pyspark.ml.linalg import Vectors

    chance = np.random.default_rng(4)
    data = np.column_stack((1e6 + 3e-4 * chance.random(200), chance.poisson(0.1, 200), chance.random(200)))
    data[:, 2] += data[:, 0] - 1e6
    dense = spark.createDataFrame([(Vectors.dense(r),) for r in data.tolist()], ["features"])
    sparse = spark.createDataFrame([(Vectors.sparse(3, list(enumerate(r))),) for r in data.tolist()], ["features"])
    one = {(r.i, r.j): r.r for r in correlate.corr_matrix_vector(dense).collect()}
    two = {(r.i, r.j): r.r for r in correlate.corr_matrix_vector(sparse).collect()}
    expected = np.corrcoef((data - [1e6, 0, 0]).T)
    assert all(one[i, j] == pytest.approx(two[i, j], abs=1e-9) == pytest.approx(expected[i, j], abs=1e-5) for i, j in one)


def test_moments_leave_nulls_out(spark):
    given = [(1.0, [1.0, None]), (0.0, [3.0, 4.0]), (0.0, [5.0, 8.0]), (1.0, [2.0, 6.0]), (None, [9.0, 0.0]), (1.0, [0.0, None])]
    rows = spark.createDataFrame(given, "y double, v array<double>")
    named = rows.select("y", F.col("v")[0].alias("a"), F.col("v")[1].alias("b"))
    got = {r.pos: r for r in p.array_moments(rows, "v", 2).collect()}
    for i, r in enumerate(p.mean_variance(named, ["a", "b"]).collect()):
        assert (got[i].n, got[i]["mean"], got[i].variance) == pytest.approx((r.n, r["mean"], r.variance))
    by_array = {r.pos: r.r for r in correlate.corr_target_array(rows, "y", "v", 2).collect()}
    for i, r in enumerate(correlate.corr_target(named, "y", ["a", "b"]).collect()):
        assert by_array[i] == pytest.approx(r.r)


def test_array_moments_on_sparse_rows(spark):
    rng = np.random.default_rng(1)
    data = rng.poisson(0.15, (500, 12)).astype(float) * rng.integers(1, 9, (500, 12))
    data[:, 3] = 0.0
    y = (data[:, 0] + rng.poisson(0.4, 500) > 0).astype(float)
    rows = spark.createDataFrame([(float(a), row.tolist()) for a, row in zip(y, data, strict=True)], "y double, v array<double>")
    got = {r.pos: r for r in p.array_moments(rows.repartition(5), "v", 12, "y").collect()}
    assert sorted(got) == list(range(12))
    for i in range(12):
        assert got[i].n == 500
        assert got[i].mean == pytest.approx(data[:, i].mean())
        assert got[i].variance == pytest.approx(data[:, i].var(ddof=1))
        if i != 3:
            assert got[i].r == pytest.approx(np.corrcoef(y, data[:, i])[0, 1])
    assert got[3].r is None


def test_array_moments_run_as_one_pass(spark, sf):
    """The input is scanned once, whatever the width."""
    rows = obs(spark, sf).select(F.col("value").alias("y"), F.array("lat", "lon").alias("v"))
    plan = p.array_moments(rows, "v", 2, "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    # No inferred test of the array's size: it would compute the array a second time.
    assert "size(" not in plan


def test_zscore(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, flat double")
    got = np.array([tuple(r) for r in e.zscore(rows, ["a", "flat"]).collect()])
    a = np.array([1.0, 2.0, 4.0])
    assert np.allclose(sorted(got[:, 0]), (a - a.mean()) / a.std(ddof=1))
    assert set(got[:, 1]) == {5.0}
    arrays = rows.select(F.array("a", "flat", "a").alias("v"))
    got = np.array([r.v for r in e.zscore_array(arrays, "v", 3, skip_last=1).collect()])
    assert np.allclose(sorted(got[:, 0]), (a - a.mean()) / a.std(ddof=1))
    assert set(got[:, 1]) == {5.0} and sorted(got[:, 2]) == [1.0, 2.0, 4.0]


def test_confusion(spark):
    lines = [f"S{i},{y},{q}" for i, (y, q) in enumerate([(0.0, 0), (0.0, 1), (1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)])]
    rows = evaluate.parse_predictions(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert tuple(evaluate.confusion_accuracy(rows).first()) == (1, 1, 1, 1, 6, pytest.approx(2 / 6))


def test_auc_is_exact(spark):
    rows = spark.range(5000).select((F.hash("id") % 2 == 0).cast("double").alias("label"), F.rand(3).alias("score"))
    pdf = rows.toPandas()
    rank = pdf.score.rank()
    pos = pdf.label.sum()
    want = (rank[pdf.label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(pdf) - pos))
    assert evaluate.auc_roc(rows) == pytest.approx(want, abs=1e-12)


def test_zip_index_is_dense_and_ordered(spark):
    rows = spark.range(10_000).select((F.hash("id").cast("bigint") * 100_000 + F.col("id")).alias("k")).repartition(6)
    got = [tuple(r) for r in o.zip_index(rows, "k").orderBy("k").collect()]
    assert [i for _, i in got] == list(range(10_000))


def test_running_total(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 5).alias("n"))
    got = o.running_total(rows, "id", amount="n").orderBy("id").collect()
    assert [r.before for r in got] == np.concatenate([[0], np.cumsum(np.arange(1000) % 5)[:-1]]).tolist()


def test_group_chunks_bound_a_hot_key(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], "id bigint, k string"))
    chunks = p.group_chunks(rows, "k", "id", rows_per_chunk=100).select("k", F.size("rows").alias("n")).collect()
    assert sum(r.n for r in chunks) == 6001
    assert max(r.n for r in chunks) < 200
    assert sum(1 for r in chunks if r.k is None) == 1


def test_sparse_where_smaller(spark):
    rows = spark.createDataFrame([([0.0] * 50,), ([1.0] * 50,)], "v array<double>")
    kinds = [type(r.features).__name__ for r in e.sparse_vector(rows, "v", 50).collect()]
    assert kinds == ["SparseVector", "DenseVector"]
    assert not math.isnan(sum(sum(r.features.toArray()) for r in e.sparse_vector(rows, "v", 50).collect()))


def wide_rows(spark, width, n=300, offset=0.0):
    """Sparse counts with ties, negative numbers, and every tenth column far from 0."""
    chance = np.random.default_rng(width)
    x = chance.integers(-3, 6, (n, width)) * (chance.random((n, width)) < 0.3) + chance.random((n, 1)).round(1)
    x[:, ::10] += offset
    x[:, 1] = 7.25
    return x, spark.createDataFrame([(row.tolist(),) for row in x] + [(None,), ([None] * width,)], "values array<double>").repartition(5)


@pytest.mark.parametrize("cells", [1 << 22, 1 << 14])
def test_tiles_equal_the_matrix(spark, cells, monkeypatch):
    """More columns than a tile holds; with few cells a pass takes a stripe of them."""
    from fieldtally.operators import gramian

    monkeypatch.setattr(gramian, "CELLS", cells)
    monkeypatch.setattr(gramian, "AT_ONCE", 20_000)
    x, rows = wide_rows(spark, 300, offset=1e6)
    found = {(r.i, r.j): r.r for r in correlate.corr_matrix_array(rows, "values").collect()}
    x[:, ::10] -= 1e6
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x.T)
    assert len(found) == 300 * 300
    for (i, j), r in found.items():
        assert r is None if 1 in (i, j) else r == pytest.approx(want[i, j], abs=1e-9)


@pytest.mark.parametrize("heavy", [2, 256])
def test_wide_ranks_equal_average_ranks(spark, heavy, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(correlate, "HEAVY", heavy)
    x, rows = wide_rows(spark, 40)
    x[:, 2] = 0.0
    rows = rows.withColumn("values", F.transform("values", lambda v, i: F.when(i == 2, v * 0).otherwise(v)))
    found = {(r.i, r.j): r.r for r in correlate.spearman_matrix_array(rows, "values", 40).collect()}
    want = pd.DataFrame(x).corr("spearman").to_numpy()
    for i in range(40):
        for j in range(40):
            r = found[i, j]
            assert r is None if {1, 2} & {i, j} else r == pytest.approx(want[i, j], abs=1e-9)


def test_matrix_of_no_rows(spark):
    none = spark.createDataFrame([], "values array<double>")
    assert correlate.corr_matrix_array(none, "values", 3).count() == 0 and correlate.corr_matrix_array(none, "values").count() == 0
    assert correlate.spearman_matrix_array(none, "values", 3).count() == 0
    assert correlate.corr_matrix(spark.createDataFrame([], "a double, b double"), ["a", "b"]).count() == 0


def test_no_matrix_on_the_driver(spark):
    """1,657 columns: what the driver gets is two numbers for each, and the tiles stay in the shared folder."""
    x, rows = wide_rows(spark, 1657, n=40)
    matrix = correlate.corr_matrix_array(rows, "values")
    assert matrix.count() == 1657**2
    assert matrix.filter("i = j AND r IS NOT NULL AND abs(r - 1) > 1e-9").count() == 0


def test_area_and_variance_equal_all_pairs(spark):
    chance = np.random.default_rng(5)
    rows = [(g, int(chance.integers(2)), float(chance.integers(12)) / 4) for g in "ab" for _ in range(90)] + [("c", 1, 1.0), ("d", 0, 1.0), ("d", 1, 2.0)]
    odd = [("a", None, 1.0), ("a", 1, None), ("b", 7, 1.0)]
    found = {r.g: r for r in evaluate.grouped_auc(spark.createDataFrame(rows + odd, "g string, label int, score double"), ["g"]).collect()}
    for g in "ab":
        p, q = (np.array([s for h, y, s in rows if h == g and y == k]) for k in (1, 0))
        wins = (p[:, None] > q[None, :]) + 0.5 * (p[:, None] == q[None, :])
        assert (found[g].positives, found[g].negatives) == wins.shape
        assert found[g].auc == pytest.approx(wins.mean())
        assert found[g].variance == pytest.approx(wins.mean(axis=1).var(ddof=1) / len(p) + wins.mean(axis=0).var(ddof=1) / len(q))
    assert found["c"].auc is None and found["d"].auc == 1.0 and found["d"].variance is None
    whole = evaluate.grouped_auc(spark.createDataFrame(rows, "g string, label int, score double"))
    assert whole.first().auc == pytest.approx(evaluate.auc_roc(spark.createDataFrame(rows, "g string, label int, score double")))
    assert evaluate.grouped_auc(spark.createDataFrame([], "label int, score double")).first().auc is None
