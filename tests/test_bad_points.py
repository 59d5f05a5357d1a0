"""One rule for bad points on every path, null-safe errors, refused weights,
the wide row path, and the split cache."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold.operators.descent import gradient_descent, sgd
from linfold.operators.metrics import constant_rmse, rmse, rmse_many
from linfold.operators.moments import collect_moments, moments_frame
from linfold.operators import rowwise
from linfold.operators.rowwise import gd_rowwise, gradient_pass, sgd_rowwise
from linfold.operators.splits import hash_split, one_split, random_split
from linfold.plans.pipeline import Pipeline

SCHEMA = "point_id long, label double, features array<double>, split string"
GOOD = [(1, 1.0, [1.0, 2.0], "train"), (2, 3.0, [2.0, 1.0], "train")]
BAD = {
    "null label": [(3, None, [1.0, 2.0], "train")],
    "null features": [(3, 1.0, None, "train")],
    "null among them": [(3, 1.0, [1.0, None], "train")],
    "short": [(3, 1.0, [1.0], "train")],
    "long": [(3, 1.0, [1.0, 2.0, 9.0], "train")],
    "ragged of equal total": [(3, 1.0, [1.0, 2.0, 3.0], "train"), (4, 1.0, [4.0], "train")],
}


@pytest.mark.parametrize("method", ["columns", "arrow", "rows"])
@pytest.mark.parametrize("case", [None, *BAD])
def test_bad_points_fail_on_every_path(spark, case, method):
    df = spark.createDataFrame(GOOD + BAD.get(case, []), SCHEMA).coalesce(1)

    def run():
        if method == "rows":
            return gradient_pass(df, 2, np.array([1.0, 1.0]))[3]
        return collect_moments(moments_frame(df, 2, method=method, fanout=1))["train"].n
    if case is None:
        assert run() == 2
    else:
        with pytest.raises(Exception, match="bad point"):
            run()


def test_pipeline_scoring_fails_on_bad_points(spark):
    df = spark.createDataFrame(GOOD + BAD["long"], SCHEMA).drop("split")
    with pytest.raises(Exception, match="bad point"):
        Pipeline(spark, df, 2).moments()


def test_rmse_counts_only_rows_with_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (None, 2.0, "a"), (1.0, None, "a")],
                               "label double, prediction double, split string")
    one = rmse(df).collect()[0]
    assert one.n == 1 and one.rmse == 1.0
    many = rmse_many(df, {"m": F.col("prediction")}).collect()[0]
    assert many.n == 1 and many.rmse == 1.0
    labels = df.select("label", F.lit("train").alias("split"))
    for fanout in (1, 4):
        got = constant_rmse(labels, fanout=fanout).collect()[0]
        assert got.n == 2 and got.rmse == 0.0


def test_weights_the_buckets_cannot_hold_are_refused(spark):
    df = spark.range(10).withColumnRenamed("id", "point_id")
    with pytest.raises(ValueError):
        hash_split(df, (.9996, .0002, .0002))
    assert hash_split(df, (.5, .25, .25)).count() == 10


def test_one_split_equals_hash_split(spark):
    df = spark.range(500).withColumnRenamed("id", "point_id")
    whole = hash_split(df)
    for name in ("train", "validation", "test"):
        a = sorted(r.point_id for r in one_split(df, name).collect())
        assert a == sorted(r.point_id for r in whole.where(F.col("split") == name).collect()) and a


def test_random_split_is_one_pass(spark):
    plan = random_split(spark.range(1000))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Union" not in plan and "Sample" not in plan
    n = {r.split: r["count"] for r in random_split(spark.range(20000)).groupBy("split").count().collect()}
    assert sum(n.values()) == 20000 and abs(n["train"] - 16000) < 5 * (20000 * .16) ** .5


def _rows(spark, n, d, seed=0):
    rng = np.random.default_rng(seed)
    x, y = rng.random((n, d)), rng.random(n)
    df = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)],
                               "label double, features array<double>").repartition(4)
    return df, x, y


def test_row_path_equals_moments(spark):
    df, x, y = _rows(spark, 200, 50)
    m = collect_moments(moments_frame(df.withColumn("split", F.lit("train")), 50))["train"]
    w, trace = gradient_descent(m, 5, .05, .1)
    w2, trace2 = gd_rowwise(df, 50, 5, .05, .1)
    assert np.allclose(w, w2, rtol=1e-9) and np.allclose(trace, trace2, rtol=1e-9)
    a = sgd(m, 6, .05, .01, True, snapshots=[2, 4])
    b = sgd_rowwise(df, 50, 6, .05, .01, True, snapshots=[2, 4])
    for k in (2, 4, 6):
        assert np.allclose(a.snapshots[k].weights, b.snapshots[k].weights, rtol=1e-9)
        assert a.snapshots[k].iterations == b.snapshots[k].iterations


@pytest.mark.parametrize("d", [3, 50, 700])
def test_staged_points_pass_equals_rows(spark, d):
    df, x, y = _rows(spark, 90, d)
    w = np.linspace(-1, 1, d)
    err = x @ w + .5 - y
    forms = [rowwise.packed(df, d), rowwise.by_column(df, d)][:2 if d <= 50 else 1]
    for rows in [df, *forms]:
        g, gb, sse, n = gradient_pass(rows, d, w, .5)
        assert n == 90 and np.allclose(g, err @ x) and np.allclose([gb, sse], [err.sum(), err @ err])
        g, gb, sse, n = gradient_pass(rows.limit(0), d, w, .5)
        assert n == 0 and gb == sse == 0 and not g.any()
    blocks = [len(r.points) for r in forms[0].collect()]
    assert sum(blocks) == 90 * 8 * (d + 1) and max(blocks) <= max(rowwise.BLOCK_BYTES, 8 * (d + 1))
    if d == 3:
        bad = df.union(spark.createDataFrame([(1.0, [1.0, None, 2.0])], df.schema))
        for make in (rowwise.packed, rowwise.by_column):
            with pytest.raises(Exception, match="bad point"):
                make(bad, d).collect()


def test_narrow_row_path_stays_in_the_jvm(spark, monkeypatch):
    df, x, y = _rows(spark, 80, 3)
    seen, real = [], rowwise._column_pass
    monkeypatch.setattr(rowwise, "_column_pass", lambda rows, *a: seen.append(rows.columns) or real(rows, *a))
    w, trace = gd_rowwise(df, 3, 4, .05, .1)
    v, expected = np.zeros(3), []
    for i in range(4):
        err = x @ v - y
        expected.append(np.sqrt(np.mean(err ** 2)))
        v = v - .05 / (80 * np.sqrt(i + 1)) * (err @ x + .1 * v)
    assert np.allclose(w, v) and np.allclose(trace, expected)
    assert seen == [["label", "x0", "x1", "x2"]] * 4


def test_row_path_forms_interactions(spark):
    df, x, y = _rows(spark, 60, 4)
    z = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(60, 16)])
    w = np.linspace(-1, 1, 20)
    g, _, sse, n = gradient_pass(df, 4, w, 0.0, interactions=True)
    err = z @ w - y
    assert n == 60 and np.allclose(g, err @ z) and sse == pytest.approx(err @ err)


def test_wide_rows_in_one_quick_pass(spark):
    df, x, y = _rows(spark, 1000, 2000)
    df = df.cache()
    df.count()
    w = np.full(2000, .001)
    gradient_pass(df, 2000, w)  # workers and code are warm
    t = time.time()
    g, _, _, n = gradient_pass(df, 2000, w)
    took = time.time() - t
    df.unpersist()
    assert n == 1000 and np.allclose(g, (x @ w - y) @ x) and took < 5


def test_every_trainer_takes_the_row_path_when_wide(spark, monkeypatch):
    import linfold.plans.pipeline as P
    df, _, _ = _rows(spark, 120, 3)
    points = df.withColumn("point_id", F.monotonically_increasing_id())
    narrow = P.Pipeline(spark, points, 3)
    want = (narrow.gd(4, .1)[0].weights, narrow.sgd(4, .1).weights, narrow.sgd_runs([2, 4], .1, .1)[2].weights)
    monkeypatch.setattr(P, "MOMENTS_MAX_WIDTH", 2)
    wide = P.Pipeline(spark, points, 3)
    got = (wide.gd(4, .1)[0].weights, wide.sgd(4, .1).weights, wide.sgd_runs([2, 4], .1, .1)[2].weights)
    for a, b in zip(want, got):
        assert np.allclose(a, b, rtol=1e-9)
    with pytest.raises(ValueError, match="too wide"):
        wide.moments()


def test_split_cache_and_release(spark):
    df, _, _ = _rows(spark, 100, 3)
    p = Pipeline(spark, df.withColumn("point_id", F.monotonically_increasing_id()), 3, persist=True)
    n = p.data.count()
    assert p.data.storageLevel.useMemory and n == 100
    assert sum(p.split(s).count() for s in ("train", "validation", "test")) == 100
    p.release()
    assert not p.data.storageLevel.useMemory
