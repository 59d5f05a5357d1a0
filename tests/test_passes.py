"""How often queries pass over their rows."""

import pytest

import __spark_entry__ as E
from conftest import SF001


def _jobs(spark, run):
    sc = spark.sparkContext
    sc.setJobGroup("passes", "passes")
    before = set(sc.statusTracker().getJobIdsForGroup("passes"))
    out = run()
    return out, len(set(sc.statusTracker().getJobIdsForGroup("passes")) - before)


@pytest.mark.parametrize("name", ["split_sizes", "split_assign", "baseline_rmse", "train_mean", "random_split_sizes",
                                  "label_hist", "label_range"])
def test_no_pass_before_the_frame(spark, name):
    """Nothing runs until the frame is asked for: no pass for the label shift."""
    E.queries()[name](spark, SF001)  # files are listed and their schema read
    _, jobs = _jobs(spark, lambda: E.queries()[name](spark, SF001))
    assert jobs <= 1  # the schema of the table


def _scans(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Scan parquet")


def test_scans_of_the_final_plan(spark):
    q = E.queries()
    assert _scans(q["train_mean"](spark, SF001)) == 1
    assert _scans(q["baseline_rmse"](spark, SF001)) == 1
    assert _scans(q["split_assign"](spark, SF001)) == 1


def test_split_hash_runs_once_in_a_split(spark):
    df = E.queries()["sgd_predict"](spark, SF001)
    # above the scan, whose line names its filters once more
    assert df._jdf.queryExecution().executedPlan().toString().split("FileScan")[0].count("md5(") == 1
