"""Driver contract, golden values at sf0.01, and oracle agreement at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from linfold.plans.queries import REGISTRY as BASE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    # every query of the pipeline has an oracle; the training-data queries list theirs
    assert {k for k in set(q) - set(o) if k in BASE} == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "model", "rmse"] and len(rows) == 9


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in BASE.items() if sql is not None))
def test_oracle_agrees_sf0001(spark, con, name):
    df = E.queries()[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = sorted(tuple(_norm(r[i]) for i in so) for r in s_rows)
    b = sorted(tuple(_norm(r[i]) for i in do) for r in d_rows)
    assert a == b


def _val(rows, **kw):
    for r in rows:
        if all(r[k] == v for k, v in kw.items()):
            return r
    raise KeyError(kw)


def test_golden_signal_sf001(spark):
    q = E.queries()
    sizes = {r.split: r.n for r in q["split_sizes"](spark, SF01).collect()}
    assert sizes == {"train": 48190, "validation": 5882, "test": 5928}
    assert q["train_mean"](spark, SF01).collect()[0].train_mean == pytest.approx(31.442353, abs=1e-6)
    base = {r.split: r.rmse for r in q["baseline_rmse"](spark, SF01).collect()}
    assert base == pytest.approx({"train": 16.842463, "validation": 16.855087, "test": 16.958827}, abs=1e-6)
    tr = {r.iteration: r.rmse for r in q["gd_trace"](spark, SF01).collect()}
    assert tr[0] == pytest.approx(35.669176, abs=1e-6) and tr[49] == pytest.approx(4.906868, abs=1e-6)
    grid = q["grid_search"](spark, SF01).collect()
    assert _val(grid, trial=0).iterations_run == 71
    assert _val(grid, trial=0).rmse == pytest.approx(8.930674, abs=1e-6)
    assert _val(grid, is_best=True).reg_param == 1e-10
    inter = {(r.split, r.model): r.rmse for r in q["interact_rmse"](spark, SF01).collect()}
    assert inter[("validation", "LRInteract")] == pytest.approx(1.865314, abs=1e-6)
    assert inter[("test", "LRInteract")] == pytest.approx(1.863575, abs=1e-6)


def test_golden_embed_sf001(spark):
    q = E.queries()
    w = [r.weight for r in sorted(q["gd_weights_embed"](spark, SF01).collect(), key=lambda r: r.feature)]
    assert w[0] == pytest.approx(0.507394, abs=1e-6) and w[-1] == pytest.approx(0.756459, abs=1e-6)
    grid = q["grid_search_embed"](spark, SF01).collect()
    assert _val(grid, is_best=True).trial == 0  # the incumbent stays
    sweep = {(r.step, r.num_iters): r for r in q["step_sweep"](spark, SF01).collect()}
    assert sweep[(10.0, 500)].log10_rmse == pytest.approx(141.913827, abs=1e-3)
    assert sweep[(10.0, 5)].log10_rmse == pytest.approx(7.498730, abs=1e-3)
    assert sweep[(1e-5, 500)].iterations_run == 2
    ie = {r.split: r for r in q["interact_embed"](spark, SF01).collect()}
    assert all(r.width == 156 and r.iterations_run == 87 for r in ie.values())
    assert ie["validation"].rmse == pytest.approx(2.979604, abs=1e-6)
    assert ie["test"].rmse == pytest.approx(3.202258, abs=1e-6)
