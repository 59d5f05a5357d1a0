"""Moments paths, split properties, aggregates (Spark)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold.operators.features import label_range, shift_labels
from linfold.operators.metrics import label_histogram, residuals
from linfold.operators.moments import collect_moments, moments_frame
from linfold.operators.splits import hash_split, random_split, split_bucket, split_sizes


@pytest.fixture(scope="module")
def pts(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(1990 + rng.integers(0, 10)), [float(v) for v in rng.random(3)])
            for i in range(300)]
    return spark.createDataFrame(rows, "point_id long, label double, features array<double>")


def test_columns_arrow_numpy_agree(spark, pts):
    data = hash_split(pts)
    a = collect_moments(moments_frame(data, 3, interactions=True, method="columns"))
    b = collect_moments(moments_frame(data, 3, interactions=True, method="arrow"))
    local = data.collect()
    for split in ("train", "validation", "test"):
        rows = [r for r in local if r.split == split]
        x = np.array([r.features for r in rows])
        z = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(len(x), 9)])
        y = np.array([r.label for r in rows])
        for m in (a[split], b[split]):
            assert m.n == len(rows)
            assert np.allclose(m.xtx, z.T @ z) and np.allclose(m.xty, z.T @ y)
            assert m.syy == pytest.approx(y @ y)
        base = collect_moments(moments_frame(data, 3, fanout=1))[split]
        assert np.allclose(a[split].sub(3).xtx, base.xtx)


def test_hash_split_stable_under_repartition(spark, pts):
    a = {r.point_id: r.split for r in hash_split(pts).collect()}
    b = {r.point_id: r.split for r in hash_split(pts.repartition(7)).collect()}
    assert a == b and set(a.values()) == {"train", "validation", "test"}


def test_split_bucket_known_value(spark):
    got = spark.range(1).select(split_bucket(F.lit("1")).alias("b")).collect()[0].b
    assert got == 499  # first 8 hex digits of md5('42|1') mod 1000


def test_split_sizes_add_up(spark, pts):
    rows = split_sizes(hash_split(pts)).collect()
    assert sum(r.n for r in rows) == 300 and all(r.total == 300 and r.sizes_add_up for r in rows)


def test_random_split_partitions_all_rows(spark, pts):
    rs = random_split(pts)
    assert rs.count() == 300 and rs.select("point_id").distinct().count() == 300


def test_shift_starts_at_zero_and_histogram_invariant(spark, pts):
    sh = shift_labels(pts)
    assert label_range(sh).collect()[0].min_label == 0.0
    h1 = sorted((r.n) for r in label_histogram(pts).collect())
    h2 = sorted((r.n) for r in label_histogram(sh).collect())
    assert h1 == h2


def test_ideal_residuals_are_zero(spark, pts):
    res = residuals(pts, F.col("label")).collect()
    assert all(r.sq_error == 0.0 and r.scaled_error == 0.0 for r in res)


def test_tree_agg_equals_plain(spark, pts):
    from linfold.operators.aggregates import tree_agg
    spec = [("s", "sum", F.col("label")), ("c", "count", F.lit(1)), ("lo", "min", F.col("label"))]
    a = {r.split: (r.s, r.c, r.lo) for r in tree_agg(hash_split(pts), ["split"], spec, 4).collect()}
    b = {r.split: (r.s, r.c, r.lo) for r in tree_agg(hash_split(pts), ["split"], spec, 1).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][1:] == b[k][1:] and a[k][0] == pytest.approx(b[k][0])


def test_constant_rmse_tree_equals_rows(spark, pts):
    from linfold.operators.metrics import constant_rmse, rmse
    data = hash_split(pts)
    mean = data.where("split = 'train'").agg(F.avg("label")).collect()[0][0]
    want = {r.split: r.rmse for r in rmse(data.withColumn("prediction", F.lit(mean)), by=("split",)).collect()}
    for fanout in (1, 4):
        got = {r.split: r.rmse for r in constant_rmse(data.repartition(6), fanout=fanout).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], rel=1e-12)


@pytest.mark.parametrize("interactions", [False, True])  # column path; Arrow path (width 30)
def test_pipeline_resolves_min_inside_moments_pass(spark, pts, interactions):
    from linfold.plans.pipeline import Pipeline
    rng = np.random.default_rng(11)
    rows = [(i, 1990.25 + float(rng.integers(0, 40)) * 0.5, [float(v) for v in rng.random(5)])
            for i in range(400)]
    df = spark.createDataFrame(rows, "point_id long, label double, features array<double>")
    p = Pipeline(spark, df, 5)
    got = p.moments(interactions)           # one pass: moments and min(label)
    assert p._lo_known and p.min_label == min(r[1] for r in rows)
    want = collect_moments(moments_frame(p.data, 5, interactions=interactions))
    for split, m in want.items():
        g = got[split]
        assert g.n == m.n
        for a, b in [(g.sy, m.sy), (g.syy, m.syy)]:
            assert a == pytest.approx(b, rel=1e-12, abs=1e-9)
        assert np.allclose(g.xty, m.xty, rtol=1e-12, atol=1e-9)
        assert np.allclose(g.xtx, m.xtx, rtol=1e-12) and np.allclose(g.sx, m.sx, rtol=1e-12)


def test_shifted_histogram_from_raw_histogram(spark, pts):
    from linfold.operators.metrics import shifted_label_histogram
    direct = sorted(tuple(r) for r in label_histogram(shift_labels(pts)).collect())
    derived = sorted(tuple(r) for r in shifted_label_histogram(pts).select("label", "n").collect())
    assert derived == direct and derived[0][0] == 0.0
