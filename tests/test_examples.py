"""The reference's worked examples as unit tests."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.vectors import gradient_summand, predict, two_way_interactions
from linfold.operators.metrics import rmse
from linfold.sources.text import parse_points

SAMPLE = "2001.0,0.884,0.610,0.600,0.474,0.247,0.357,0.344,0.33,0.600,0.425,0.60,0.419"


def test_parse_sample_line(spark):
    lines = spark.createDataFrame([(SAMPLE,)], "value string")
    row = parse_points(lines).collect()[0]
    assert row.label == 2001.0
    assert len(row.features) == 12
    assert row.features[0] == 0.884 and row.features[-1] == 0.419


def test_rmse_example(spark):
    pairs = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    got = rmse(pairs).collect()[0].rmse
    assert got == pytest.approx(math.sqrt(5 / 3), abs=1e-12)
    assert round(got, 3) == 1.291


def test_gradient_summand_examples(spark):
    df = spark.createDataFrame([(2.0, [3.0, 1.0, 4.0])], "label double, features array<double>")
    one = df.select(gradient_summand("features", "label", [1, 1, 1]).alias("g")).collect()[0].g
    assert one == [18.0, 6.0, 24.0]
    df2 = spark.createDataFrame([(3.0, [-1.4, 4.2, 2.1])], "label double, features array<double>")
    two = df2.select(gradient_summand("features", "label", [0.24, 1.2, -1.4]).alias("g")).collect()[0].g
    assert np.allclose(two, [1.7304, -5.1912, -2.5956], atol=1e-12)


def test_labeled_prediction_examples(spark):
    df = spark.createDataFrame([(2.0, [1.0, 0.5]), (1.5, [0.5, 0.5])], "label double, features array<double>")
    got = df.select("label", predict("features", [1.0, 1.5]).alias("p")).collect()
    assert [(r.label, r.p) for r in got] == [(2.0, 1.75), (1.5, 1.25)]


def test_two_way_interactions_example(spark):
    df = spark.createDataFrame([(0.0, [2.0, 3.0])], "label double, features array<double>")
    fixed = df.select(two_way_interactions("features", 2).alias("z")).collect()[0].z
    generic = df.select(two_way_interactions("features").alias("z")).collect()[0].z
    assert fixed == [2.0, 3.0, 4.0, 6.0, 6.0, 9.0] == generic


# The reference's saved hyperparameter grid (F6).
SAVED_ITERS = [10, 50, 100, 250, 500, 1000]
SAVED_REGS = [1e-8, 1e-6, 1e-4, 1e-2, 1e-1, 1.0]
SAVED_RMSE = [
    [20.36769649, 20.36770128, 20.36818057, 20.41795354, 21.09778437, 301.54258421],
    [19.04948826, 19.0495, 19.05067418, 19.16517726, 19.97967727, 23.80077467],
    [18.40149024, 18.40150998, 18.40348326, 18.59457491, 19.82155716, 23.80077467],
    [17.5609346, 17.56096749, 17.56425511, 17.88442127, 19.71577117, 23.80077467],
    [17.0171705, 17.01721288, 17.02145207, 17.44510574, 19.69124734, 23.80077467],
    [16.58074813, 16.58079874, 16.58586512, 17.11466904, 19.6860931, 23.80077467],
]


def test_saved_grid_pivot_and_zoom(spark):
    from linfold.plans.search import grid_pivot, grid_zoom, reg_label
    rows = [(it, reg, SAVED_RMSE[i][j], j, i) for i, it in enumerate(SAVED_ITERS)
            for j, reg in enumerate(SAVED_REGS)]
    grid = spark.createDataFrame(rows, "num_iters int, reg_param double, rmse double, reg_idx int, iter_idx int")
    piv = {r.num_iters: r for r in grid_pivot(grid).collect()}
    assert len(piv) == 6
    assert piv[10][reg_label(1.0)] == 301.54258421
    assert piv[1000][reg_label(1e-8)] == 16.58074813
    zoom = grid_zoom(grid).collect()
    assert len(zoom) == 12
    assert {r.num_iters for r in zoom} == {250, 500, 1000}
    assert {r.reg_param for r in zoom} == {1e-8, 1e-6, 1e-4, 1e-2}
