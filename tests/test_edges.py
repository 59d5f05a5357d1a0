"""Edge cases: one row, constant label, empty splits, divergence."""

import math

import numpy as np

from linfold.plans.pipeline import Pipeline


def _pipe(spark, rows):
    df = spark.createDataFrame(rows, "point_id long, label double, features array<double>")
    return Pipeline(spark, df, 2)


def test_one_row_gives_null_rmse_for_empty_splits(spark):
    p = _pipe(spark, [(1, 2000.0, [0.5, 0.25])])
    m = p.moments()
    assert sum(v.n for v in m.values()) == 1
    sc = {(r.split, r.model): (r.n, r.rmse) for r in p.score({"Baseline": p.baseline()}).collect()}
    assert len(sc) == 3
    empty = [v for v in sc.values() if v[0] == 0]
    assert len(empty) == 2 and all(v[1] is None for v in empty)
    lr1 = p.sgd()  # trains on whatever the train split holds (maybe nothing)
    assert np.all(np.isfinite(lr1.weights))


def test_constant_label(spark):
    rows = [(i, 1999.0, [i / 100.0, 1.0 - i / 100.0]) for i in range(100)]
    p = _pipe(spark, rows)
    assert p.min_label == 1999.0
    assert p.baseline().value == 0.0
    sc = p.score({"Baseline": p.baseline()}).collect()
    assert all(r.rmse == 0.0 for r in sc if r.n > 0)
    model, trace = p.gd(20)
    assert trace[0] == 0.0 and np.allclose(model.weights, 0.0)


def test_divergent_step_stays_representable(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.integers(0, 80)), [float(v) for v in rng.random(2) * 10]) for i in range(200)]
    p = _pipe(spark, rows)
    m = p.sgd(5, 10.0, 0.0)
    r = {x.split: x.rmse for x in p.score({"m": m}).collect()}
    assert all(v is None or v > 0 or math.isnan(v) for v in r.values())
    assert p.stability(10.0) > 2.0


def test_pipeline_sgd_tolerance_off_runs_every_iteration(spark):
    from linfold.plans.pipeline import Pipeline
    rows = [(i, float(i % 7), [float(i % 3), float(i % 5) / 5.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "point_id long, label double, features array<double>")
    p = Pipeline(spark, df, 2)
    stopped = p.sgd(200, 0.5, 0.0, True)
    full = p.sgd(200, 0.5, 0.0, True, tol=0.0)
    assert stopped.info["iterations"] < 200 and full.info["iterations"] == 200


def test_moments_table_one_row_lists_only_its_split(spark):
    from linfold.plans.reports import moment_terms, moments_table
    p = _pipe(spark, [(1, 2000.0, [0.5, 0.25])])
    rows = moments_table(p).collect()
    assert {r.split for r in rows} == {s for s, m in p.moments().items() if m.n == 1}
    got = {r.term: r.value for r in rows}
    assert list(got) == moment_terms(2) and got["n"] == 1.0 and got["y"] == 0.0
    assert got["x0"] == 0.5 and got["xx0_1"] == 0.125 and got["xy1"] == 0.0
