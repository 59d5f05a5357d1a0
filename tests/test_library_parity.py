"""The moments rule against the library trainer it restates (test oracle only)."""

import warnings

import numpy as np
import pytest

from linfold.operators.descent import sgd
from linfold.operators.moments import Moments


@pytest.mark.parametrize("step,reg,iters", [(1.0, 0.1, 500), (0.5, 1e-10, 200), (1e-5, 0.1, 500),
                                            (1.0, 1.0, 50)])
def test_matches_mllib_sgd(spark, step, reg, iters):
    mllib = pytest.importorskip("pyspark.mllib.regression")
    rng = np.random.default_rng(11)
    x = rng.random((60, 3))
    y = 20 + x @ np.array([5.0, -3.0, 2.0]) + rng.normal(0, 0.5, 60)
    pts = [mllib.LabeledPoint(float(yi), xi.tolist()) for xi, yi in zip(x, y)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        model = mllib.LinearRegressionWithSGD.train(
            spark.sparkContext.parallelize(pts, 3), iterations=iters, step=step,
            miniBatchFraction=1.0, regParam=reg, regType="l2", intercept=True)
    m = Moments(60, float(y.sum()), float(y @ y), x.sum(0), x.T @ y, x.T @ x)
    ours = sgd(m, iters, step, reg, intercept=True)
    assert np.allclose(ours.weights, model.weights.toArray(), atol=1e-8)
    assert ours.intercept == pytest.approx(model.intercept, abs=1e-8)


def test_rowwise_path_matches_moments(spark):
    from linfold.operators.rowwise import sgd_rowwise
    rng = np.random.default_rng(5)
    x = rng.random((50, 2))
    y = 3 + x @ np.array([1.0, 2.0])
    df = spark.createDataFrame([(float(a), [float(v) for v in b]) for a, b in zip(y, x)],
                               "label double, features array<double>")
    r = sgd_rowwise(df, 2, 100, 1.0, 0.01, intercept=True)
    m = Moments(50, float(y.sum()), float(y @ y), x.sum(0), x.T @ y, x.T @ x)
    ours = sgd(m, 100, 1.0, 0.01, intercept=True)
    assert r.iterations == ours.iterations
    assert np.allclose(r.weights, ours.weights, atol=1e-10)
    assert r.intercept == pytest.approx(ours.intercept, abs=1e-10)


def test_minibatch_runs(spark):
    from linfold.operators.rowwise import sgd_rowwise
    rng = np.random.default_rng(5)
    x = rng.random((200, 2))
    y = 3 + x @ np.array([1.0, 2.0])
    df = spark.createDataFrame([(float(a), [float(v) for v in b]) for a, b in zip(y, x)],
                               "label double, features array<double>")
    r = sgd_rowwise(df, 2, 20, 0.5, 0.0, intercept=True, mini_batch_fraction=0.5)
    assert np.all(np.isfinite(r.weights)) and r.iterations >= 2
