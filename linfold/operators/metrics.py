"""Counts, histograms, squared error and RMSE as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfold.functions.vectors import squared_error
from linfold.operators.aggregates import checked_arrays, default_fanout, tree_agg, vector_sum
from linfold.operators.features import min_max_scale
from linfold.operators.models import ConstantModel, LinearModel
from linfold.operators.rowwise import linear

MATRIX_BYTES = 256 << 20  # of broadcast weights


def rmse(pairs: DataFrame, label: str = "label", prediction: str = "prediction",
         by: Sequence[str] = (), fanout: int | None = None) -> DataFrame:
    """``sqrt(sum((label - prediction)^2) / n)``, ``n`` the rows that have both;
    null for an empty group."""
    err = squared_error(label, prediction)
    agg = tree_agg(pairs, by, [("sse", "sum", err), ("n", "count", err)], fanout)
    return agg.select(*by, "n", F.when(F.col("n") > 0, F.sqrt(F.col("sse") / F.col("n")))
                      .alias("rmse"))


def rmse_many(points: DataFrame, predictions: Mapping[str, Column], label: str = "label",
              by: Sequence[str] = ("split",), fanout: int | None = None) -> DataFrame:
    """RMSE of several prediction columns in one pass: ``(by..., model, n, rmse)``;
    ``n`` counts the rows that have a label and that model's prediction."""
    names = list(predictions)
    errors = [squared_error(label, predictions[m]) for m in names]
    specs = [(f"_{kind}{i}", kind, e) for i, e in enumerate(errors) for kind in ("sum", "count")]
    agg = tree_agg(points, by, specs, fanout)
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"_sum{i}").alias("sse"), F.col(f"_count{i}").alias("n"))
        for i, m in enumerate(names)
    ])).alias("_r")
    out = agg.select(*by, rows).select(*by, "_r.*")
    return out.select(*by, "model", "n",
                      F.when(F.col("n") > 0, F.sqrt(F.col("sse") / F.col("n"))).alias("rmse"))


def rmse_matrix(points: DataFrame, models: Mapping[str, LinearModel | ConstantModel], d: int,
                by: str = "split") -> DataFrame:
    """``rmse_many`` for many or wide models: ``(by, model, n, rmse)``.

    The weights are broadcast as one matrix (models x width, checked against
    ``MATRIX_BYTES``) and a batch's predictions are one product with it; each
    task sends one vector of squared-error sums per group. Interaction models are
    scored as ``w . x + x' W x``. Bad points fail."""
    names = list(models)
    plain = [m for m in names if not models[m].interactions]
    crossed = [m for m in names if models[m].interactions]
    if sum(8 * len(models[m].weights) for m in names) > MATRIX_BYTES:
        raise ValueError(f"the weights of {len(names)} models take over {MATRIX_BYTES} bytes: score them in parts")
    matrix = np.zeros((d, len(plain)))
    for k, m in enumerate(plain):
        matrix[:len(models[m].weights), k] = models[m].weights
    shift = np.array([models[m].intercept for m in plain + crossed])
    held = points.sparkSession.sparkContext.broadcast((matrix, [models[m].weights for m in crossed], shift))

    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        matrix, wide, shift = held.value
        acc: dict[str, np.ndarray] = {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            keys, (y, x) = rb.column(0).to_numpy(zero_copy_only=False), checked_arrays(rb, d)
            with np.errstate(all="ignore"):  # diverged weights give infinite errors
                scored = np.hstack([x @ matrix, *[linear(x, w, d, True)[:, None] for w in wide]]) + shift
                errors = np.square(scored - y[:, None])
                for key in np.unique(keys):
                    own = errors[keys == key]
                    vec = acc.setdefault(key, np.zeros(1 + len(shift)))
                    vec += np.append(len(own), own.sum(axis=0))
        if acc:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.string()), pa.array([part] * len(acc), pa.int32()),
                                              pa.array(list(acc.values()), pa.list_(pa.float64()))], names=[by, "part", "vec"])

    rows = points.select(F.col(by).cast("string").alias(by), F.col("label").cast("double").alias("label"), "features")
    sums = vector_sum(rows.mapInArrow(partial, f"`{by}` string, part int, vec array<double>"), by)
    order = F.lit(plain + crossed)
    return (sums.select(by, F.col("vec")[0].cast("long").alias("n"), F.posexplode(F.slice("vec", 2, len(names))).alias("k", "sse"))
            .select(by, F.element_at(order, F.col("k") + 1).alias("model"), "n",
                    F.when(F.col("n") > 0, F.sqrt(F.col("sse") / F.col("n"))).alias("rmse")))


def constant_rmse(points: DataFrame, label: str = "label", split: str = "split",
                  fit: str = "train", fanout: int | None = None) -> DataFrame:
    """RMSE per split of the constant model that predicts the mean label of
    ``fit``, in one pass: ``rmse_s = sqrt(var_s + (mean_s - mean_fit)^2)``.

    Count, mean and population variance are numerically stable partial
    aggregates. With ``fanout`` > 1 they are first taken per (split, task
    bucket) and merged per split with Chan's formula, so the hot split never
    funnels one partial row per task into a single reducer."""
    fanout = default_fanout(points) if fanout is None else fanout
    y = F.col(label)
    if fanout <= 1:
        per = points.groupBy(split).agg(F.count(y).alias("n"), F.avg(y).alias("mean"),
                                        F.var_pop(y).alias("var"))
    else:
        bucket = (F.spark_partition_id() % F.lit(fanout)).alias("_bucket")
        lvl1 = points.groupBy(split, bucket).agg(F.count(y).alias("nb"),
                                                 F.avg(y).alias("mb"), F.var_pop(y).alias("vb"))
        w = Window.partitionBy(split)
        lvl1 = lvl1.withColumn("_mean", F.sum(F.col("nb") * F.col("mb")).over(w) / F.sum("nb").over(w))
        per = lvl1.groupBy(split).agg(
            F.sum("nb").alias("n"), F.first("_mean").alias("mean"),
            (F.sum(F.col("nb") * F.col("vb") + F.col("nb") * (F.col("mb") - F.col("_mean"))
                   * (F.col("mb") - F.col("_mean"))) / F.sum("nb")).alias("var"))
    # ``per`` holds one row per split, so a key-less window over it is a
    # bounded single-task step; the fit mean then needs no second scan.
    c = F.max(F.when(F.col(split) == F.lit(fit), F.col("mean"))).over(Window.partitionBy())
    return per.select(split, "n", F.sqrt(F.col("var") + (F.col("mean") - c) * (F.col("mean") - c))
                      .alias("rmse"))


def label_histogram(points: DataFrame, label: str = "label") -> DataFrame:
    """Points per label: ``(label, n)`` (map-side combined hash aggregate)."""
    return tree_agg(points, [label], [("n", "count", F.lit(1))])


def shifted_label_histogram(points: DataFrame, label: str = "label") -> DataFrame:
    """Points per shifted label (``label - min(label)``), ``(label, n)``.

    Built from the raw-label histogram, re-keyed by the shift: beside that
    histogram (``label_histograms``) it reuses its exchange, so the pair
    costs the minimum's pass plus one histogram pass, not two. Keys are
    re-aggregated after the shift, so labels that round to the same shifted
    value still form one group."""
    hist = label_histogram(points, label)
    lo = hist.select(F.min(label)).scalar()
    return hist.select((F.col(label) - lo).alias(label), "n").groupBy(label) \
        .agg(F.sum("n").alias("n"))


def residuals(points: DataFrame, prediction: Column, label: str = "label",
              keys: Sequence[str] = ("point_id",)) -> DataFrame:
    """``(keys..., label, prediction, sq_error, scaled_error)``; the scaled error
    is min-max normalised over the whole frame (0 when all errors are equal)."""
    base = points.select(*keys, F.col(label).alias("label"), prediction.alias("prediction"))
    base = base.withColumn("sq_error", squared_error("label", "prediction"))
    return min_max_scale(base, "sq_error", "scaled_error")
