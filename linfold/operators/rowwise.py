"""Per-iteration training on the rows, for widths beyond D x D moments.

Each iteration is one pass: a task forms every row's residual and adds up
one vector ``[sum err * x (D), sum err, sum err^2, n]``; the tasks' vectors are
summed (wide ones in two levels, ``vector_sum``) and D + 3 numbers reach the driver. All
three rules run on it: the plain and L2 descents and the library trainer, with
snapshots. ``mini_batch_fraction < 1`` draws by a hash of id and iteration where
``id_col`` names the rows, which any engine can repeat; otherwise it samples with
seed ``seed + i`` as the library trainer does, statistically equal to it.

The training rows are staged once as parquet in the shared folder
(``stage=True``), so each iteration reads a compact copy instead of re-deriving
the rows from the source; interactions are never formed (``linear``). Full-batch
runs of up to ``COLUMNS_MAX_WIDTH`` features stage one column per feature, and a
pass is one code-generated aggregate that never leaves the JVM. Wider ones stage
``packed`` blocks: the doubles of some neighbouring points, one after the other,
in one binary value of at most ``BLOCK_BYTES``, so a pass moves bytes that numpy
reads in place and no list per row. Mini-batches draw single rows and are staged
by row. Every job is a fresh plan over the staged rows, so lineage does not grow
with the iteration count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.vectors import sql_double
from linfold.operators.aggregates import checked_arrays, checked_points, tree_agg, vector_sum
from linfold.operators.descent import (
    SGD_CONVERGENCE_TOL, SGDResult, descend, descend_sgd,
)
from linfold.operators.moments import COLUMNS_MAX_WIDTH
from linfold.session import remove_path, stage_parquet

# One value of packed points: a reader's batch of 4096 values stays within 16 MB.
BLOCK_BYTES = 4096


def linear(x: np.ndarray, w: np.ndarray, d: int, interactions: bool) -> np.ndarray:
    """``w . z`` of a batch; with interactions ``w . x + x' W x``, so that a batch
    takes n x d numbers and not n x (d + d^2)."""
    if not interactions:
        return x @ w
    return x @ w[:d] + ((x @ w[d:].reshape(d, d)) * x).sum(axis=1)


def drawn(rows: DataFrame, fraction: float, seed: int, iteration: int, id_col: str) -> DataFrame:
    """The rows of one iteration's mini-batch: those whose bucket, the first 8
    hex digits of ``md5('<seed>|<id>|<iteration>')`` mod 1000, is under the fraction.
    Independent of partitioning, so a lost task draws the same rows again and
    any SQL engine can repeat the run."""
    share = fraction * 1000
    if abs(share - round(share)) > 1e-6:
        raise ValueError(f"a mini-batch fraction by id must be a multiple of 1/1000: {fraction}")
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string"), F.lit(f"|{iteration}")))
    return rows.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000 < int(round(share)))


def _names(d: int) -> list[str]:
    return ["label", *[f"x{k}" for k in range(d)]]


def by_column(rows: DataFrame, d: int) -> DataFrame:
    """The points of ``rows`` as ``(label, x0, x1, ...)``; bad points fail."""
    return checked_points(rows, d).select(
        F.col("label").cast("double").alias("label"), *[F.col("features")[k].alias(f"x{k}") for k in range(d)])


def _column_pass(rows: DataFrame, d: int, w: np.ndarray, b: float) -> tuple[np.ndarray, float, float, int]:
    """``gradient_pass`` of the points of ``by_column``."""
    terms = [f"x{k} * {sql_double(w[k])}" for k in range(d)]
    err = F.expr(" + ".join([*terms, sql_double(b)]) + " - label")
    sums = tree_agg(rows.withColumn("err", err), [], [
        *[(f"g{k}", "sum", f"err * x{k}") for k in range(d)],
        ("e", "sum", "err"), ("sse", "sum", "err * err"), ("n", "count", "1")], fanout=1).collect()[0]
    v = np.array([sums[k] or 0.0 for k in range(d + 2)])  # no rows: null sums
    return v[:d], float(v[d]), float(v[d + 1]), int(sums["n"] or 0)


def packed(rows: DataFrame, d: int) -> DataFrame:
    """The points of ``rows`` as ``(points BINARY)``: label and features of each,
    row by row, as doubles; bad points fail. A value holds points of one batch of
    one task, at most ``BLOCK_BYTES`` of them unless a single point is longer."""
    size = 8 * (d + 1)
    many = max(1, BLOCK_BYTES // size)

    def pack(batches):
        import pyarrow as pa
        for rb in batches:
            if rb.num_rows == 0:
                continue
            y, x = checked_arrays(rb, d)
            ends = np.append(np.arange(0, len(y), many), len(y)) * size
            data = np.concatenate([y[:, None], x], axis=1)
            for k in range(0, len(ends) - 1, 1000):
                part = ends[k:k + 1001]
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                    pa.binary(), len(part) - 1,
                    [None, pa.py_buffer((part - part[0]).astype(np.int32)),
                     pa.py_buffer(data.reshape(-1)[part[0] // 8:part[-1] // 8])])], names=["points"])

    return rows.select(rows.label.cast("double").alias("label"), "features") \
        .mapInArrow(pack, "points binary")


def _packed_arrays(batch, d: int):
    """(labels, features as an n x d matrix) of a batch of ``packed``."""
    points = batch.column("points")
    _, offsets, data = points.buffers()
    lo, hi = np.frombuffer(offsets, np.int32)[[points.offset, points.offset + len(points)]]
    m = np.frombuffer(data, np.float64, (hi - lo) // 8, lo).reshape(-1, d + 1)
    return m[:, 0], m[:, 1:]


def gradient_pass(rows: DataFrame, d: int, w: np.ndarray, b: float = 0.0,
                  interactions: bool = False) -> tuple[np.ndarray, float, float, int]:
    """(sum err * x, sum err, sum err^2, n) with ``err = w.x + b - label`` of
    ``(label, features)`` rows, or of these ``by_column`` or ``packed``."""
    if rows.columns == _names(d) and not interactions:
        return _column_pass(rows, d, w, b)
    width = d + d * d if interactions else d
    blocks = rows.columns == ["points"]
    arrays = _packed_arrays if blocks else checked_arrays

    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        acc, any_rows = np.zeros(width + 3), False
        for rb in batches:
            if rb.num_rows == 0:
                continue
            any_rows = True
            y, x = arrays(rb, d)
            err = linear(x, w, d, interactions) + b - y
            acc[:d] += err @ x
            if interactions:  # sum err * (x x') without the products of any row
                acc[d:width] += ((x * err[:, None]).T @ x).ravel()
            acc[width:] += (err.sum(), err @ err, len(y))
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(["all"]), pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([acc], pa.list_(pa.float64()))], names=["key", "part", "vec"])

    points = rows if blocks else rows.select(rows.label.cast("double").alias("label"), "features")
    got = vector_sum(points.mapInArrow(partial, "key string, part int, vec array<double>"), "key").collect()
    v = np.array(got[0]["vec"]) if got else np.zeros(width + 3)
    return v[:width], float(v[width]), float(v[width + 1]), int(v[width + 2])


def _staged(train: DataFrame, stage: bool, run: Callable[[DataFrame], object], d: int,
            interactions: bool, by_row: Iterable[str] | None = None):
    """``run`` on the staged rows: by column or packed, or with the columns
    ``by_row`` row by row."""
    if not stage:
        return run(train)
    if by_row is not None:
        rows = train.select(*by_row, "label", "features")
    elif interactions or d > COLUMNS_MAX_WIDTH:
        rows = packed(train, d)
    else:
        rows = by_column(train, d)
    staged, path = stage_parquet(rows, "rowwise-train")
    try:
        return run(staged)
    finally:
        remove_path(train.sparkSession, path)


def gd_rowwise(train: DataFrame, d: int, num_iters: int, alpha: float = 1.0, eta: float = 0.0,
               interactions: bool = False, stage: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``linfold.operators.descent.gradient_descent`` on the rows."""
    width = d + d * d if interactions else d

    def run(rows):
        def step(w):
            g, _, sse, n = gradient_pass(rows, d, w, 0.0, interactions)
            return g, (np.sqrt(sse / n) if n else float("nan")), n
        return descend(step, width, num_iters, alpha, eta)
    return _staged(train, stage, run, d, interactions)


def sgd_rowwise(train: DataFrame, d: int, iterations: int = 100, step: float = 1.0,
                reg: float = 0.0, intercept: bool = False, tol: float = SGD_CONVERGENCE_TOL,
                mini_batch_fraction: float = 1.0, seed: int = 42, stage: bool = True,
                interactions: bool = False, snapshots: Iterable[int] = (),
                id_col: str | None = None) -> SGDResult:
    """The squared-L2 rule of ``linfold.operators.descent.sgd`` on the rows."""
    width = d + d * d if interactions else d

    def run(rows):
        def mean_gradient(w, i):
            if mini_batch_fraction >= 1.0:
                part = rows
            elif id_col:
                part = drawn(rows, mini_batch_fraction, seed, i, id_col)
            else:
                part = rows.sample(withReplacement=False, fraction=mini_batch_fraction, seed=seed + i)
            g, gb, _, n = gradient_pass(part, d, w[:width], float(w[-1]) if intercept else 0.0, interactions)
            if n == 0:
                return None
            return (np.append(g, gb) if intercept else g) / n
        return descend_sgd(mean_gradient, width, iterations, step, reg, intercept, tol, snapshots)
    by_row = None if mini_batch_fraction >= 1.0 else [id_col] if id_col else []
    return _staged(train, stage, run, d, interactions, by_row)
