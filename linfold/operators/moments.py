"""Sufficient statistics of least squares, grouped by split (one pass).

For points ``(y, x)`` with width D the moments per group are::

    n, sy = sum y, syy = sum y^2, sx = sum x, xty = sum y x, xtx = sum x x^T

With them every quantity the descents need is a D x D computation:
the gradient sum is ``xtx w - xty`` and the squared-error sum is
``w'xtx w - 2 w'xty + syy``. Their size is O(D^2) whatever the row count,
so they are the only thing that reaches the driver.

Two physical paths, both one scan:

* ``columns`` (small D): one code-generated aggregate with
  D(D+1)/2 + 2D + 3 sum columns, through the two-level ``tree_agg``.
* ``arrow`` (large D, e.g. 156 interaction features): ``mapInArrow``
  builds one vector of partial sums per task and split with numpy
  (interactions are expanded inside the task, never shipped);
  ``vector_sum`` adds them in two levels.

Both paths fail on a bad point (null label, null or ragged features).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.vectors import term_sql
from linfold.operators.aggregates import checked_arrays, checked_points, tree_agg, vector_sum

COLUMNS_MAX_WIDTH = 24
# Above this width the D x D moments (D^2 / 2 doubles per split) stop being
# "small"; training then uses the per-iteration row path instead.
MOMENTS_MAX_WIDTH = 1024


@dataclass
class Moments:
    n: int
    sy: float
    syy: float
    sx: np.ndarray
    xty: np.ndarray
    xtx: np.ndarray

    @classmethod
    def empty(cls, d: int) -> "Moments":
        return cls(0, 0.0, 0.0, np.zeros(d), np.zeros(d), np.zeros((d, d)))

    @property
    def d(self) -> int:
        return int(self.sx.shape[0])

    def sub(self, k: int) -> "Moments":
        """Moments of the first ``k`` features (a leading block)."""
        return Moments(self.n, self.sy, self.syy, self.sx[:k].copy(), self.xty[:k].copy(),
                       self.xtx[:k, :k].copy())

    def shifted(self, delta: float) -> "Moments":
        """Moments of the labels ``y + delta``."""
        return Moments(self.n, self.sy + self.n * delta,
                       self.syy + 2.0 * delta * self.sy + self.n * delta * delta,
                       self.sx.copy(), self.xty + delta * self.sx, self.xtx.copy())

    def augmented(self) -> "Moments":
        """Moments with a constant-1 feature appended last (for an intercept)."""
        d = self.d
        g = np.empty((d + 1, d + 1))
        g[:d, :d] = self.xtx
        g[:d, d] = self.sx
        g[d, :d] = self.sx
        g[d, d] = float(self.n)
        return Moments(self.n, self.sy, self.syy, np.append(self.sx, float(self.n)),
                       np.append(self.xty, self.sy), g)

    def sse(self, w: np.ndarray, intercept: float = 0.0) -> float:
        """Sum of squared errors of ``w . x + intercept`` from the moments."""
        if intercept:
            m = self.augmented()
            w = np.append(w, intercept)
        else:
            m = self
        return float(w @ m.xtx @ w - 2.0 * (w @ m.xty) + m.syy)


def _triu(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def moments_frame(points: DataFrame, d: int, by: str = "split", interactions: bool = False,
                  method: str = "auto", fanout: int | None = None,
                  min_of: str | None = None, checked: bool = False) -> DataFrame:
    """Long moments ``(split, k INT, value DOUBLE)`` in the layout
    ``[n, sy, syy, sx(D), xty(D), triu(xtx)]`` where D = d or d + d^2.

    ``min_of`` names a column whose per-group minimum rides along in the
    same pass, as the row ``k = -1``. ``checked``: the points passed
    ``checked_points`` already."""
    if not checked:
        points = checked_points(points, d)
    width = d + d * d if interactions else d
    if method == "auto":
        method = "columns" if width <= COLUMNS_MAX_WIDTH else "arrow"
    if method == "columns":
        return _moments_columns(points, d, by, interactions, fanout, min_of)
    if method == "arrow":
        return _moments_arrow(points, d, by, interactions, min_of)
    raise ValueError(f"unknown moments method {method!r}")


def _moments_columns(points, d, by, interactions, fanout, min_of=None):
    z = term_sql("features", d, interactions)
    width = len(z)
    y = "label"
    specs = [("m0", "count", "1"), ("m1", "sum", y), ("m2", "sum", f"{y} * {y}")]
    k = 3
    for c in z:
        specs.append((f"m{k}", "sum", c))
        k += 1
    for c in z:
        specs.append((f"m{k}", "sum", f"{c} * {y}"))
        k += 1
    for i, j in _triu(width):
        specs.append((f"m{k}", "sum", f"{z[i]} * {z[j]}"))
        k += 1
    if min_of is not None:
        specs.append(("mlo", "min", f"`{min_of}`"))
    wide = tree_agg(points, [by], specs, fanout)
    arr = ", ".join(f"CAST(m{i} AS DOUBLE)" for i in range(k))
    if min_of is None:
        return wide.select(by, F.expr(f"posexplode(array({arr})) AS (k, value)"))
    long = wide.select(by, F.expr(f"posexplode(array({arr}, CAST(mlo AS DOUBLE))) AS (k, value)"))
    return long.select(by, F.when(F.col("k") == k, F.lit(-1)).otherwise(F.col("k")).alias("k"),
                       "value")


def _moments_arrow(points, d, by, interactions, min_of=None):
    width = d + d * d if interactions else d
    iu = np.triu_indices(width)
    size = 3 + 2 * width + len(iu[0])

    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        acc: dict[str, np.ndarray] = {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            keys = rb.column(0).to_numpy(zero_copy_only=False)
            y, x = checked_arrays(rb, d)
            if interactions:
                x = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(x.shape[0], d * d)])
            for key in np.unique(keys):
                sel = keys == key
                xs, ys = x[sel], y[sel]
                vec = acc.setdefault(key, np.zeros(size))
                vec[0] += xs.shape[0]
                vec[1] += ys.sum()
                vec[2] += ys @ ys
                vec[3:3 + width] += xs.sum(axis=0)
                vec[3 + width:3 + 2 * width] += xs.T @ ys
                vec[3 + 2 * width:] += (xs.T @ xs)[iu]
        part = TaskContext.get().partitionId()
        if acc:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(acc), pa.string()), pa.array([part] * len(acc), pa.int32()),
                 pa.array(list(acc.values()), pa.list_(pa.float64()))], names=[by, "part", "vec"])

    cols = [F.col(by).cast("string").alias(by), F.col("label").cast("double").alias("label"), "features"]
    sums = vector_sum(points.select(*cols).mapInArrow(
        partial, f"`{by}` string, part int, vec array<double>"), by)
    long = sums.select(by, F.posexplode("vec").alias("k", "value"))
    if min_of is None:
        return long
    # the minimum comes from the same rows by a code-generated aggregate of two columns
    lows = tree_agg(points, [by], [("value", "min", F.col(min_of).cast("double"))])
    return long.unionByName(lows.select(F.col(by).cast("string").alias(by), F.lit(-1).alias("k"), "value"))


def collect_moments(frame: DataFrame, by: str = "split") -> dict[str, Moments]:
    """Bring the O(D^2) long moments to the driver as ``Moments`` per group."""
    return _collect(frame, by)[0]


def collect_moments_and_min(frame: DataFrame, by: str = "split"
                            ) -> tuple[dict[str, Moments], float | None]:
    """As ``collect_moments`` for a frame built with ``min_of``; also returns
    the minimum over all groups (None when there are no rows)."""
    return _collect(frame, by)


def _collect(frame: DataFrame, by: str) -> tuple[dict[str, Moments], float | None]:
    rows = frame.select(by, "k", "value").collect()
    raw: dict[str, dict[int, float]] = {}
    lows = []
    for r in rows:
        if int(r[1]) == -1:
            if r[2] is not None:
                lows.append(float(r[2]))
            continue
        raw.setdefault(r[0], {})[int(r[1])] = float(r[2])
    out = {}
    for key, kv in raw.items():
        size = max(kv) + 1
        vec = np.array([kv.get(i, 0.0) for i in range(size)])
        # size = 3 + 2D + D(D+1)/2  ->  solve for D
        width = int(round((-5 + np.sqrt(1 + 8 * size)) / 2))
        g = np.zeros((width, width))
        iu = np.triu_indices(width)
        g[iu] = vec[3 + 2 * width:]
        g = g + np.triu(g, 1).T
        out[key] = Moments(int(round(vec[0])), float(vec[1]), float(vec[2]),
                           vec[3:3 + width].copy(), vec[3 + width:3 + 2 * width].copy(), g)
    return out, (min(lows) if lows else None)
