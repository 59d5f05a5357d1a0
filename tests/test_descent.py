"""Descent rules on moments equal the row-wise rules they restate."""

import numpy as np
import pytest

from linfold.operators.descent import gradient_descent, rmse_from_moments, sgd
from linfold.operators.moments import Moments


def moments_of(x, y):
    return Moments(len(y), float(y.sum()), float(y @ y), x.sum(0), x.T @ y, x.T @ x)


def rowwise_gd(x, y, iters, alpha=1.0, eta=0.0):
    n, d = x.shape
    w = np.zeros(d)
    trace = np.zeros(iters)
    for i in range(iters):
        trace[i] = np.sqrt(np.mean((x @ w - y) ** 2))
        g = sum((xi @ w - yi) * xi for xi, yi in zip(x, y)) + eta * w
        w = w - alpha / (n * np.sqrt(i + 1)) * g
    return w, trace


def rowwise_sgd(x, y, iters, step, reg, intercept=True, tol=1e-3):
    if intercept:
        x = np.hstack([x, np.ones((len(y), 1))])
    w = np.zeros(x.shape[1])
    if intercept:
        w[-1] = 1.0
    prev = None
    run = 0
    for i in range(1, iters + 1):
        g = sum((xi @ w - yi) * xi for xi, yi in zip(x, y)) / len(y)
        t = step / np.sqrt(i)
        w = w * (1 - t * reg) - t * g
        run = i
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w, run


@pytest.fixture
def data():
    rng = np.random.default_rng(7)
    x = rng.random((40, 3))
    y = 3 + x @ np.array([2.0, -1.0, 0.5]) + rng.normal(0, 0.1, 40)
    return x, y


def test_gd_matches_rowwise(data):
    x, y = data
    w, tr = gradient_descent(moments_of(x, y), 25)
    w2, tr2 = rowwise_gd(x, y, 25)
    assert np.allclose(w, w2, atol=1e-12) and np.allclose(tr, tr2, atol=1e-10)


def test_gd_l2_adds_eta_to_the_sum(data):
    x, y = data
    w, tr = gradient_descent(moments_of(x, y), 10, eta=0.1)
    w2, tr2 = rowwise_gd(x, y, 10, eta=0.1)
    assert np.allclose(w, w2, atol=1e-12)


def test_trace_entry_zero_is_rmse_of_zero_weights(data):
    x, y = data
    _, tr = gradient_descent(moments_of(x, y), 3)
    assert tr[0] == pytest.approx(np.sqrt(np.mean(y ** 2)))


@pytest.mark.parametrize("step,reg", [(1.0, 0.1), (0.5, 1e-10), (1e-5, 0.1), (1.0, 1.0)])
def test_sgd_matches_rowwise(data, step, reg):
    x, y = data
    r = sgd(moments_of(x, y), 500, step, reg, intercept=True)
    w2, run = rowwise_sgd(x, y, 500, step, reg)
    assert r.iterations == run
    assert np.allclose(np.append(r.weights, r.intercept), w2, atol=1e-9)


def test_sgd_without_intercept_and_no_tolerance(data):
    x, y = data
    r = sgd(moments_of(x, y), 30, 0.5, 0.0, intercept=False, tol=0.0)
    w2, run = rowwise_sgd(x, y, 30, 0.5, 0.0, intercept=False, tol=0.0)
    assert r.iterations == run == 30 and np.allclose(r.weights, w2, atol=1e-12)


def test_snapshots_equal_separate_runs(data):
    x, y = data
    m = moments_of(x, y)
    r = sgd(m, 100, 1.0, 0.01, True, snapshots=[5, 10, 50, 1000])
    for b in (5, 10, 50, 100, 1000):
        single = sgd(m, b, 1.0, 0.01, True)
        assert np.allclose(r.snapshots[b].weights, single.weights)
        assert r.snapshots[b].iterations == single.iterations


def test_small_step_stops_after_two(data):
    x, y = data
    r = sgd(moments_of(x, y), 500, 1e-5, 0.1, True)
    assert r.iterations == 2 and r.intercept == pytest.approx(1.0, abs=1e-3)


def test_errors_non_increasing_for_small_steps(data):
    x, y = data
    _, tr = gradient_descent(moments_of(x, y), 50, alpha=0.1)
    assert np.all(np.diff(tr) <= 1e-12)


def test_rmse_from_moments(data):
    x, y = data
    w = np.array([1.0, 2.0, 3.0])
    assert rmse_from_moments(moments_of(x, y), w, 0.5) == pytest.approx(
        np.sqrt(np.mean((x @ w + 0.5 - y) ** 2)))


def test_empty_split_gives_nan():
    m = Moments(0, 0.0, 0.0, np.zeros(2), np.zeros(2), np.zeros((2, 2)))
    assert np.isnan(rmse_from_moments(m, np.zeros(2)))
    r = sgd(m, 10, 1.0, 0.1, True)
    assert r.iterations == 0
