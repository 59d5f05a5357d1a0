"""Descent rules evaluated on moments (O(D^2) work per iteration on the driver).

``gradient_descent`` -- the plain / L2 batch rule with a decaying step:
    trace[i] = RMSE(w_i) (before the update), g = sum((w.x - y) x) + eta * w,
    w_{i+1} = w_i - alpha / (n * sqrt(i + 1)) * g,  w_0 = 0, no intercept.
    eta is added to the *sum*, so the shrink per step is eta / n.

``sgd`` -- least squares with a squared-L2 updater (full batch):
    optional intercept = a constant-1 feature appended last, initial weights 0
    and initial intercept 1.0; for i = 1, 2, ...:
    g = (X'X w - X'y) / n, t = step / sqrt(i), w <- w (1 - t reg) - t g
    (the intercept is shrunk too); stop after ``iterations`` or, from the
    second iteration on, when ||w_new - w|| < tol * max(||w_new||, 1).
    reg multiplies the *mean* gradient scale: never share it with eta.

Because a run's path never depends on its iteration budget, one run
answers every budget (``snapshots``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np

from linfold.operators.moments import Moments

# Fixed values of the library trainer's defaults.
SGD_DEFAULT_ITERATIONS = 100
SGD_DEFAULT_STEP = 1.0
SGD_CONVERGENCE_TOL = 0.001
SGD_INITIAL_INTERCEPT = 1.0


def rmse_from_moments(m: Moments, w: np.ndarray, intercept: float = 0.0) -> float:
    if m.n == 0:
        return float("nan")
    return float(np.sqrt(max(m.sse(w, intercept), 0.0) / m.n))


def gradient_descent(m: Moments, num_iters: int, alpha: float = 1.0,
                     eta: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Returns (final weights, training RMSE before each update)."""
    return descend(lambda w: (m.xtx @ w - m.xty, rmse_from_moments(m, w), m.n), m.d,
                   num_iters, alpha, eta)


def descend(step: Callable[[np.ndarray], tuple[np.ndarray, float, int]], d: int, num_iters: int,
            alpha: float, eta: float) -> tuple[np.ndarray, np.ndarray]:
    """The batch rule; ``step(w)`` gives (gradient sum, RMSE, rows). No rows:
    zero weights."""
    w = np.zeros(d)
    trace = np.zeros(num_iters)
    for i in range(num_iters):
        g, trace[i], n = step(w)
        if n:
            w = w - (alpha / (n * np.sqrt(i + 1))) * (g + eta * w)
    return w, trace


@dataclass
class SGDResult:
    weights: np.ndarray
    intercept: float
    iterations: int
    converged: bool
    snapshots: dict[int, "SGDResult"] = field(default_factory=dict)
    peak_norm: float = 0.0


def sgd(m: Moments, iterations: int = SGD_DEFAULT_ITERATIONS, step: float = SGD_DEFAULT_STEP,
        reg: float = 0.0, intercept: bool = False, tol: float = SGD_CONVERGENCE_TOL,
        snapshots: Iterable[int] = ()) -> SGDResult:
    """Full-batch gradient descent with a squared-L2 updater (see module doc).

    ``snapshots`` lists further iteration budgets; each is answered from the
    same run (``result.snapshots[budget]``).
    """
    mm = m.augmented() if intercept else m
    if mm.n == 0:  # nothing to learn from: the initial weights, after no iteration
        zero = descend_sgd(lambda w, i: None, m.d, 0, step, reg, intercept, tol)
        zero.snapshots = {int(b): zero for b in (iterations, *snapshots)}
        return zero
    return descend_sgd(lambda w, i: (mm.xtx @ w - mm.xty) / mm.n,
                       m.d, iterations, step, reg, intercept, tol, snapshots)


def descend_sgd(mean_gradient: Callable[[np.ndarray, int], np.ndarray | None], d: int,
                iterations: int, step: float, reg: float, intercept: bool, tol: float,
                snapshots: Iterable[int] = ()) -> SGDResult:
    """The trainer's rule; ``mean_gradient(w, i)`` is None without rows (a
    mini-batch that drew none skips its update). The last weight is the
    intercept's, if there is one."""
    w = np.zeros(d + 1 if intercept else d)
    if intercept:
        w[-1] = SGD_INITIAL_INTERCEPT
    budgets = sorted(set([int(iterations), *(int(s) for s in snapshots)]))
    peak = float(np.linalg.norm(w))
    snaps: dict[int, SGDResult] = {}
    stopped, run, moved = False, 0, 0

    def state() -> SGDResult:
        ww, bb = (w[:-1].copy(), float(w[-1])) if intercept else (w.copy(), 0.0)
        return SGDResult(ww, bb, run, stopped, {}, peak)

    for budget in budgets:
        while run < budget and not stopped:
            grad = mean_gradient(w, run + 1)
            run += 1
            if grad is None:
                continue
            t = step / np.sqrt(run)
            w_new = w * (1.0 - t * reg) - t * grad
            moved += 1
            stopped = moved > 1 and (float(np.linalg.norm(w_new - w))
                                     < tol * max(float(np.linalg.norm(w_new)), 1.0))
            w = w_new
            peak = max(peak, float(np.linalg.norm(w)))
        snaps[budget] = state()
    final = snaps[int(iterations)]
    final.snapshots = snaps
    return final
