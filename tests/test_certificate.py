"""The conditions hold for fitted coefficients, and for no others."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fieldtally.operators import train
from fieldtally.operators.certificate import certificate

WIDTH = 6


@pytest.fixture(scope="module")
def rows(spark):
    """Features of very different scales, one of them mostly 0, one far from 0, one constant."""
    chance = np.random.default_rng(5)
    x = chance.normal(0, 1, (3000, WIDTH)) * [1, 50, 0.02, 1, 1, 0] + [0, 0, 0, 0, 400, 0]
    x[:, 3] *= chance.random(3000) < 0.1
    margin = x[:, 0] - 0.02 * x[:, 1] + 30 * x[:, 2] + (x[:, 4] - 400)
    y = (chance.random(3000) < 1 / (1 + np.exp(-margin))).astype(float)
    frame = spark.createDataFrame([(float(t), [float(v) for v in r]) for t, r in zip(y, x, strict=True)], "label double, values array<double>")
    return frame.select("label", array_to_vector("values").alias("features")).cache()


def checked(rows, b, intercept=0.0, **how):
    return {r.pos: r for r in certificate(rows, b, intercept, **how).collect()}


def test_slopes_against_numpy(rows):
    b, intercept = np.array([0.3, -0.01, 0, 2.0, 0.1, 0]), -40.0
    got = checked(rows, b, intercept, l2=0.3)
    data = rows.toPandas()
    x = np.array([v.toArray() for v in data.features])
    residual = 1 / (1 + np.exp(-(x @ b + intercept))) - data.label.to_numpy()
    deviation = x.std(axis=0, ddof=1)
    for k in range(WIDTH - 1):
        want = (residual * x[:, k]).mean() / deviation[k] + 0.3 * b[k] * deviation[k]
        assert got[k].slope == pytest.approx(want, rel=1e-9, abs=1e-12) and got[k].n == 3000
    assert got[WIDTH - 1].violation == 0.0 and got[-1].slope == pytest.approx(residual.mean())
    assert got[0].violation == pytest.approx(abs(got[0].slope)) and not got[0].optimal


@pytest.mark.parametrize("fit_intercept", [True, False])
def test_fitted_l1_is_optimal_for_its_penalty_only(rows, fit_intercept):
    model = train.logistic_l1(fitIntercept=fit_intercept, regParam=0.02).fit(rows)
    b = model.coefficients.toArray()
    how = {"intercept": model.intercept, "fit_intercept": fit_intercept}
    right = checked(rows, b, l1=0.02, **how)
    assert all(r.optimal for r in right.values()) and len(right) == WIDTH + fit_intercept
    for other in (0.01, 0.04):
        assert not all(r.optimal for r in checked(rows, b, l1=other, **how).values())
    assert not all(r.optimal for r in checked(rows, b, l2=0.02, **how).values())
    assert b[5] == 0.0 and 0.0 in b[:5]  # both kinds of condition are met


def test_fitted_l2_is_optimal_for_its_penalty_only(rows):
    for standardized in (True, False):
        model = train.logistic_weak_l2(1, 20, standardization=standardized).fit(rows)
        b = model.coefficients.toArray()
        assert all(r.optimal for r in checked(rows, b, model.intercept, l2=0.05, standardized=standardized).values())
        assert not all(r.optimal for r in checked(rows, b, model.intercept, l2=0.05, standardized=not standardized).values())
        assert not all(r.optimal for r in checked(rows, b, model.intercept, l2=0.1, standardized=standardized).values())


def test_moved_coefficient_and_dropped_rows(rows):
    model = train.logistic_l1().fit(rows)
    b = model.coefficients.toArray()
    moved = b * [1.1, 1, 1, 1, 1, 1]
    assert not checked(rows, moved, l1=0.005, fit_intercept=False)[0].optimal
    part = rows.filter((F.col("label") == 1) | (F.rand(3) < 0.5))
    assert not all(r.optimal for r in checked(part, b, l1=0.005, fit_intercept=False).values())


def test_no_rows(rows):
    got = checked(rows.limit(0), np.zeros(WIDTH))
    assert all(r.optimal is not False for k, r in got.items())
