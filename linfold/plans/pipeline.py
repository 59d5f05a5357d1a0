"""The label-prediction pipeline over one point frame.

    points -> shift labels -> hash split -> moments (one pass)
           -> descents on the driver (O(D^2) per iteration)
           -> scoring of any number of models in one pass

Nothing proportional to the row count ever leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.operators.descent import SGD_CONVERGENCE_TOL, gradient_descent, sgd
from linfold.operators.aggregates import checked_points, default_fanout, tree_agg
from linfold.operators.metrics import rmse, rmse_many, rmse_matrix
from linfold.operators.models import ConstantModel, LinearModel
from linfold.operators.moments import (
    COLUMNS_MAX_WIDTH, MOMENTS_MAX_WIDTH, Moments, collect_moments_and_min, moments_frame,
)
from linfold.operators.rowwise import gd_rowwise, sgd_rowwise
from linfold.operators.splits import SPLIT_NAMES, hash_split, one_split
from linfold.operators.tiles import collect_tiles, tiled_moments
from linfold.session import at_exit_remove, remove_path, scratch_path
from linfold.sources.fixtures import (
    EMBED_FULL_WIDTH, EMBED_WIDTH, embed_points, embed_points_full, embed_text_points, signal_points,
)

# name -> (loader, feature width)
FIXTURES = {
    "signal": (signal_points, 3),
    "embed": (embed_points, EMBED_WIDTH),
    "embed64": (embed_points_full, EMBED_FULL_WIDTH),
    "embed_text": (embed_text_points, EMBED_FULL_WIDTH),
}

# Fixed values of the reference pipeline's settings.
GD_ITERATIONS = 50
GD_ALPHA = 1.0
GD_L2_ETA = 0.1
SGD_ITERATIONS = 500
SGD_STEP = 1.0
SGD_REG = 0.1
GRID_REGS = (1e-10, 1e-5, 1.0)
SWEEP_STEPS = (1e-5, 10.0)
SWEEP_ITERATIONS = (500, 5)
HEAT_ITERATIONS = (10, 50, 100, 250, 500, 1000)
HEAT_REGS = (1e-8, 1e-6, 1e-4, 1e-2, 1e-1, 1.0)
INTERACT_REG = 1e-10

# Models whose terms are more than this are scored as a matrix product instead of
# one expression per model; the result is the same.
MATRIX_TERMS = 512


class Pipeline:
    """Holds the split point frame and caches its moments on the driver."""

    def __init__(self, spark: SparkSession, points: DataFrame, d: int,
                 fanout: int | None = None, persist: bool = False):
        self.spark = spark
        self.d = d
        # bad points fail every pass that reads features
        self.points = checked_points(points, d)
        self.fanout = default_fanout(points) if fanout is None else fanout
        self._persist = persist
        self._lo: float | None = None
        self._lo_known = False
        self._data: DataFrame | None = None
        self._stored: str | None = None
        self._moments: dict[bool, dict[str, Moments]] = {}

    # The minimum label is resolved once; every later pass over ``data`` then
    # sees it as a literal. A training query gets it from its moments pass
    # (no pass of its own); other queries run one small aggregate over the
    # label columns.
    @property
    def min_label(self) -> float | None:
        if not self._lo_known:
            lo = tree_agg(self.points, [], [("lo", "min", F.col("label"))], self.fanout)
            self._set_min(lo.collect()[0][0])
        return self._lo

    def _set_min(self, lo: float | None) -> None:
        self._lo, self._lo_known = lo, True

    def _shifted_split(self, by: Column) -> DataFrame:
        cols = [c for c in self.points.columns if c != "label"]
        return hash_split(self.points.select(*cols, (F.col("label") - by).alias("label"),
                                             F.col("label").alias("_label_raw")))

    @property
    def data(self) -> DataFrame:
        """The split points with shifted labels: ``(..., label, split)``."""
        if self._data is None:
            lo = self.min_label
            cols = [c for c in self.points.columns if c != "label"]
            data = hash_split(self.points.select(*cols, (F.col("label") - F.lit(lo)).alias("label")))
            if self._persist:
                data = data.persist(StorageLevel.MEMORY_AND_DISK)
            self._data = data
        return self._data

    @property
    def unshifted(self) -> DataFrame:
        """The split points with labels as they came: no pass for the minimum."""
        return hash_split(self.points)

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, name: str = "signal",
                     **kw) -> "Pipeline":
        loader, d = FIXTURES[name]
        return cls(spark, loader(spark, sf_dir), d, **kw)

    def store(self) -> "Pipeline":
        """Write the split rows once, partitioned by split, under the shared folder;
        later passes read them, and one split reads only its own files."""
        if self._stored is None:
            path = scratch_path(self.spark, "split")
            at_exit_remove(self.spark, path)
            self.data.write.partitionBy("split").parquet(path)
            if self._persist:
                self._data.unpersist()
            # an empty input leaves no partitions to infer the split's type from
            self._data = self.spark.read.schema(self.data.schema).parquet(path)
            self._stored = path
        return self

    def release(self) -> None:
        """Drop the cached split frame (``persist=True``) or the stored one."""
        if self._stored is not None:
            remove_path(self.spark, self._stored)
            self._stored = self._data = None
        elif self._data is not None:
            self._data.unpersist()

    # ---- data ---------------------------------------------------------
    def split(self, name: str) -> DataFrame:
        if self._persist or self._stored:  # the kept frame has the split as a column
            return self.data.where(F.col("split") == F.lit(name))
        lo = self.min_label
        return one_split(self.points.withColumn("label", F.col("label") - F.lit(lo)), name)

    def _collected(self, data: DataFrame, interactions: bool, min_of: str | None = None):
        """The moments of ``data`` per split, and the minimum of ``min_of``, in one
        pass: a code-generated aggregate for narrow models, tiles for wide ones."""
        if self.width(interactions) > COLUMNS_MAX_WIDTH:
            frame = tiled_moments(data, self.d, interactions=interactions, min_of=min_of, checked=True)
            return collect_tiles(frame, self.d, interactions=interactions)
        frame = moments_frame(data, self.d, interactions=interactions, fanout=self.fanout, min_of=min_of, checked=True)
        return collect_moments_and_min(frame)

    def moments_frame(self, interactions: bool = False) -> DataFrame:
        return moments_frame(self.data, self.d, interactions=interactions, fanout=self.fanout,
                             checked=True)

    def moments(self, interactions: bool = False) -> dict[str, Moments]:
        """Per-split moments, one Spark job. The interaction moments contain
        the base moments as their leading block, so they answer both."""
        if self.wide(interactions):
            raise ValueError(f"{self.width(interactions)} features are too wide for moments"
                             f" (over {MOMENTS_MAX_WIDTH}); train on the rows")
        if interactions not in self._moments:
            if not interactions and True in self._moments:
                self._moments[False] = {k: m.sub(self.d) for k, m in self._moments[True].items()}
            elif self._lo_known:
                got = self._collected(self.data, interactions)[0]
            else:
                got = self._moments_resolving_min(interactions)
            if interactions not in self._moments:
                w = self.width(interactions)
                for name in SPLIT_NAMES:  # an empty split has zero moments
                    got.setdefault(name, Moments(0, 0.0, 0.0, np.zeros(w), np.zeros(w),
                                                 np.zeros((w, w))))
                self._moments[interactions] = got
        return self._moments[interactions]

    def _moments_resolving_min(self, interactions: bool) -> dict[str, Moments]:
        """Moments and the minimum label in one pass.

        Labels are first shifted by a provisional ``c`` (one label read by a
        ``limit(1)`` job, which touches a single split of the input, not the
        table), so the sums stay as small as the shifted labels' and moving
        them to the exact minimum ``lo`` afterwards (``y - lo = (y - c) +
        (c - lo)``) loses no precision. The exact ``min(label)`` rides along
        in the same aggregate."""
        y = F.col("label")
        finite = y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf")))
        first = self.points.where(finite).select("label").limit(1).collect()
        if not first:  # no finite label: resolve the minimum by its own pass
            return self._collected(self.data, interactions)[0]
        c = float(first[0][0])
        got, lo = self._collected(self._shifted_split(F.lit(c)), interactions, "_label_raw")
        self._set_min(lo)
        if lo is None:
            return got
        return {k: m.shifted(c - lo) for k, m in got.items()}

    # ---- models -------------------------------------------------------
    def baseline(self) -> ConstantModel:
        tr = self.moments()["train"]
        return ConstantModel("Baseline", tr.sy / tr.n if tr.n else float("nan"))

    def train_mean(self) -> DataFrame:
        """Lazy one-row ``train_mean``: mean and label shift in one pass."""
        y = F.when(F.col("split") == "train", F.col("label"))
        one = tree_agg(self.unshifted, [], [("s", "sum", y), ("n", "count", y),
                                            ("lo", "min", F.col("label"))], self.fanout)
        return one.select((F.col("s") / F.col("n") - F.col("lo")).alias("train_mean"))

    def baseline_predictions(self) -> DataFrame:
        """Every point with the training mean (a scalar subquery) as prediction."""
        mean = self.train_mean().scalar()
        return self.data.withColumn("prediction", mean)

    def gd(self, num_iters: int = GD_ITERATIONS, alpha: float = GD_ALPHA, eta: float = 0.0,
           name: str = "LR0", interactions: bool = False) -> tuple[LinearModel, np.ndarray]:
        if self.wide(interactions):
            w, trace = gd_rowwise(self.split("train"), self.d, num_iters, alpha, eta, interactions)
        else:
            w, trace = gradient_descent(self.moments(interactions)["train"], num_iters, alpha, eta)
        return LinearModel(name, w, 0.0, self.d, interactions,
                           {"num_iters": num_iters, "alpha": alpha, "eta": eta}), trace

    def width(self, interactions: bool = False) -> int:
        return self.d + self.d * self.d if interactions else self.d

    def wide(self, interactions: bool = False) -> bool:
        """Too wide for D x D moments: every trainer then runs on the rows."""
        return self.width(interactions) > MOMENTS_MAX_WIDTH

    def sgd(self, iterations: int = SGD_ITERATIONS, step: float = SGD_STEP, reg: float = SGD_REG,
            intercept: bool = True, interactions: bool = False, name: str = "LR1",
            snapshots: Sequence[int] = (), mini_batch_fraction: float = 1.0,
            tol: float = SGD_CONVERGENCE_TOL) -> LinearModel:
        """The library rule. From moments when they are small; on the rows (one
        aggregate per iteration) for very wide features or mini-batches, which are
        drawn by a hash of id and iteration.
        ``tol`` is the relative convergence tolerance; 0 runs every iteration
        (the behaviour of library versions without a stop test)."""
        if mini_batch_fraction < 1.0 or self.wide(interactions):
            r = sgd_rowwise(self.split("train"), self.d, iterations, step, reg, intercept, tol=tol,
                            mini_batch_fraction=mini_batch_fraction, interactions=interactions,
                            snapshots=snapshots, id_col="point_id")
        else:
            r = sgd(self.moments(interactions)["train"], iterations, step, reg, intercept, tol=tol,
                    snapshots=snapshots)
        return _model(name, r, self.d, interactions, intercept, step, reg, iterations)

    def sgd_runs(self, budgets: Sequence[int], step: float, reg: float,
                 intercept: bool = True, interactions: bool = False) -> dict[int, LinearModel]:
        """One run, answered at every iteration budget."""
        if self.wide(interactions):
            r = sgd_rowwise(self.split("train"), self.d, max(budgets), step, reg, intercept,
                            interactions=interactions, snapshots=budgets)
        else:
            r = sgd(self.moments(interactions)["train"], max(budgets), step, reg, intercept,
                    snapshots=budgets)
        return {b: _model(f"it{b}", r.snapshots[b], self.d, interactions, intercept, step, reg, b)
                for b in budgets}

    def stability(self, step: float, intercept: bool = True, interactions: bool = False) -> float:
        """``step`` x largest eigenvalue of the training G/n: above ~2 the first
        iterations amplify, and rounding can decide where a run ends."""
        m = self.moments(interactions)["train"]
        m = m.augmented() if intercept else m
        if m.n == 0:
            return float("nan")
        return float(step * np.linalg.eigvalsh(m.xtx / m.n).max())

    # ---- scoring ------------------------------------------------------
    def score(self, models: Mapping[str, object], splits: Sequence[str] | None = None) -> DataFrame:
        """``(split, model, n, rmse)`` for every model and split, one pass over the
        rows; an empty split gives ``n = 0`` and a null RMSE."""
        names = list(SPLIT_NAMES if splits is None else splits)
        df = self.data if splits is None else self.split(names[0]) if len(names) == 1 else \
            self.data.where(F.col("split").isin(names))
        if sum(len(m.weights) for m in models.values()) > MATRIX_TERMS:
            scored = rmse_matrix(df, models, self.d)
        else:
            preds: dict[str, Column] = {k: m.prediction() for k, m in models.items()}
            scored = rmse_many(df, preds, by=("split",), fanout=self.fanout)
        grid = self.spark.createDataFrame([(s, m) for s in names for m in models],
                                          "split string, model string")
        out = grid.join(scored, ["split", "model"], "left")
        return out.select("split", "model", F.coalesce("n", F.lit(0)).alias("n"), "rmse")

    def rmse_of(self, prediction: Column, splits: Sequence[str] | None = None) -> DataFrame:
        df = self.data if splits is None else self.data.where(F.col("split").isin(list(splits)))
        return rmse(df.withColumn("prediction", prediction), by=("split",), fanout=self.fanout)


def _model(name, r, d, interactions, intercept, step, reg, budget) -> LinearModel:
    return LinearModel(name, r.weights, r.intercept, d, interactions,
                       {"iterations": r.iterations, "converged": r.converged, "step": step,
                        "reg": reg, "budget": budget, "has_intercept": intercept,
                        "peak_norm": r.peak_norm})
