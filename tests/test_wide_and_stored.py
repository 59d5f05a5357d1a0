"""Split control, tiled moments, implicit interactions, matrix scoring, mini-batches
by id, stored splits and models, counts beside training, ML vectors."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from linfold.functions.vectors import from_ml_vector, to_ml_vector
from linfold.operators import tiles
from linfold.operators.metrics import rmse_many, rmse_matrix
from linfold.operators.models import ConstantModel, LinearModel, load_models, save_models
from linfold.operators.moments import collect_moments, moments_frame
from linfold.operators.rowwise import drawn, gradient_pass, linear, sgd_rowwise
from linfold.plans import reports
from linfold.plans.pipeline import Pipeline
from linfold.sources.fixtures import mixed_lines
from linfold.sources.text import observed_points, read_lines
from test_passes import _jobs

SCHEMA = "point_id long, label double, features array<double>, split string"


def points(spark, n=60, d=5, seed=1, parts=4):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, d)), rng.normal(size=n) + 3
    split = ["train" if k % 5 else "test" for k in range(n)]
    df = spark.createDataFrame([(k, float(y[k]), [float(v) for v in x[k]], split[k]) for k in range(n)], SCHEMA).repartition(parts)
    return df, x, y, np.array(split)


# ---------------------------------------------------------------- split control
def test_natural_splits_stay(spark, tmp_path):
    path = str(tmp_path / "lines.txt")
    with open(path, "w") as f:
        f.writelines(f"{k},1.0,2.0\n" for k in range(60_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-os.path.getsize(path) // 30)))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        for least in (None, 2, 30):
            df = read_lines(spark, path, least)
            assert df.rdd.getNumPartitions() == 30
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert read_lines(spark, path, 45).rdd.getNumPartitions() >= 45
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_file_gets_the_least_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,2\n3,4\n5,6\n7,8\n")
    assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() == 1
    df = read_lines(spark, str(tmp_path / "a.txt"), 2)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r.value for r in df.collect()) == ["1,2", "3,4", "5,6", "7,8"]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"
    # settings of the session hold for what is read with another split size
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert read_lines(spark, str(tmp_path / "a.txt"), 2).sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    # frames of both sessions join
    other = spark.createDataFrame([("1,2", 1)], "value string, k int")
    assert df.join(other, "value").count() == 1
    (tmp_path / "empty.txt").write_text("")
    assert read_lines(spark, str(tmp_path / "empty.txt"), 2).count() == 0


# ---------------------------------------------------------------- tiled moments
def same(m, x, y, rel=1e-12):
    assert m.n == len(y)
    for got, want in ((m.sy, y.sum()), (m.syy, y @ y), (m.sx, x.sum(0)), (m.xty, x.T @ y), (m.xtx, x.T @ x)):
        assert np.abs(got - want).max() <= rel * max(1.0, np.abs(want).max())


@pytest.mark.parametrize("tile,held", [(2, 12), (3, 9), (7, 10_000), (128, 8_000_000)])
@pytest.mark.parametrize("crossed", [False, True])
def test_tiles_equal_numpy(spark, tile, held, crossed):
    df, x, y, split = points(spark, n=30, d=3)
    z = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)]) if crossed else x
    width = z.shape[1]
    assert sorted(sum(tiles.tile_passes(width, tile, held), [])) == sorted(set(sum(tiles.tile_passes(width, tile, held), [])))
    frame = tiles.tiled_moments(df.withColumn("raw", F.col("label") * 2), 3, interactions=crossed, min_of="raw", tile=tile, held=held)
    got, lo = tiles.collect_tiles(frame, 3, interactions=crossed, tile=tile)
    assert lo == pytest.approx(2 * y.min()) and set(got) == {"train", "test"}
    for s in got:
        same(got[s], z[split == s], y[split == s])
    rep = {(r.split, r.feature): r for r in tiles.tile_report(frame, 3, interactions=crossed, tile=tile).collect()}
    assert len(rep) == 2 * width
    g = z[split == "train"].T @ z[split == "train"]
    for k in range(width):
        r = rep["train", k]
        assert (r.row_sum, r.square_sum, r.label_sum) == pytest.approx((g[k].sum(), g[k, k], z[split == "train"][:, k] @ y[split == "train"]))


def test_tiles_of_2000_features(spark):
    df, x, y, split = points(spark, n=300, d=2000, parts=3)
    got, _ = tiles.collect_tiles(tiles.tiled_moments(df, 2000), 2000)
    same(got["train"], x[split == "train"], y[split == "train"])
    # no row holds more than a tile
    frame = tiles.tiled_moments(df, 2000)
    assert frame.select(F.max(F.size("vec"))).first()[0] <= tiles.TILE ** 2


def test_tiles_without_rows_and_with_bad_ones(spark):
    df, *_ = points(spark, n=10, d=3)
    assert tiles.collect_tiles(tiles.tiled_moments(df.limit(0), 3), 3) == ({}, None)
    bad = spark.createDataFrame([(1, None, [1.0, 2.0, 3.0], "train")], SCHEMA)
    for frame in (tiles.tiled_moments(df.union(bad), 3), rmse_matrix(df.union(bad), {"a": LinearModel("a", np.zeros(3))}, 3)):
        with pytest.raises(Exception, match="bad point"):
            frame.collect()


def test_wide_training_takes_two_passes_and_the_minimum_with_them(spark):
    df, x, y, _ = points(spark, n=200, d=30)
    _, jobs = _jobs(spark, lambda: Pipeline(spark, df.drop("split"), 30).moments())
    p = Pipeline(spark, df.drop("split"), 30)
    m = p.moments()
    assert p.min_label == y.min()
    assert sum(v.n for v in m.values()) == 200 and sum(v.sy for v in m.values()) == pytest.approx((y - y.min()).sum())
    narrow = collect_moments(moments_frame(p.data, 30, method="arrow"))
    for s in narrow:
        assert np.allclose(narrow[s].xtx, m[s].xtx) and np.allclose(narrow[s].xty, m[s].xty)


# ---------------------------------------------------------------- implicit interactions
def test_linear_and_gradient_without_products(spark):
    df, x, y, _ = points(spark, n=40, d=4)
    rng = np.random.default_rng(5)
    w, z = rng.normal(size=20), np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(40, 16)])
    assert np.allclose(linear(x, w, 4, True), z @ w)
    g, gb, sse, n = gradient_pass(df, 4, w, 0.5, interactions=True)
    err = z @ w + 0.5 - y
    assert n == 40 and gb == pytest.approx(err.sum()) and sse == pytest.approx(err @ err)
    assert np.allclose(g, err @ z)


def test_wide_interactions_train_and_score(spark):
    df, x, y, split = points(spark, n=80, d=40)
    p = Pipeline(spark, df.drop("split"), 40)
    assert p.wide(interactions=True)
    m = p.sgd(4, 0.0005, 0.01, True, interactions=True, tol=0.0)
    z = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(80, -1), np.ones((80, 1))])
    rows = {r.point_id: r.split for r in p.data.select("point_id", "split").collect()}
    train = np.array([rows[k] == "train" for k in range(80)])
    w, target = np.append(np.zeros(1640), 1.0), y - y.min()
    for i in range(1, 5):
        g = z[train].T @ (z[train] @ w - target[train]) / train.sum()
        w = w * (1 - 0.0005 / np.sqrt(i) * 0.01) - 0.0005 / np.sqrt(i) * g
    assert np.allclose(m.weights, w[:-1]) and m.intercept == pytest.approx(w[-1])
    got = {r.split: r.rmse for r in p.score({"wide": m}).collect()}
    assert got["train"] == pytest.approx(np.sqrt(np.mean((z[train] @ w - target[train]) ** 2)))


# ---------------------------------------------------------------- matrix scoring
def test_matrix_scores_equal_columns(spark):
    df, x, y, split = points(spark, n=50, d=4)
    rng = np.random.default_rng(2)
    models = {"c": ConstantModel("c", 2.5), "plain": LinearModel("plain", rng.normal(size=4), 0.0, 4), "b": LinearModel("b", rng.normal(size=4), 1.5, 4),
              "crossed": LinearModel("crossed", rng.normal(size=20), 0.5, 4, True), "off": LinearModel("off", np.full(4, np.inf), 0.0, 4)}
    key = lambda rows: {(r.split, r.model): (r.n, r.rmse) for r in rows}
    a, b = key(rmse_matrix(df, models, 4).collect()), key(rmse_many(df, {k: m.prediction() for k, m in models.items()}).collect())
    assert set(a) == set(b) and len(a) == 10
    for k in a:
        assert a[k][0] == b[k][0] and (a[k][1] == pytest.approx(b[k][1], nan_ok=True) or not np.isfinite(b[k][1]))
    assert rmse_matrix(df.limit(0), models, 4).collect() == []


def test_many_models_take_the_matrix(spark):
    df, x, y, _ = points(spark, n=50, d=30)
    p = Pipeline(spark, df.drop("split"), 30)
    models = {str(k): LinearModel(str(k), np.full(30, k / 10), 0.0, 30) for k in range(20)}
    out = p.score(models)
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()
    few = {(r.split, r.model): r.rmse for r in p.score({"3": models["3"]}).collect()}
    for r in out.collect():
        if r.model == "3" and r.n:
            assert r.rmse == pytest.approx(few[r.split, "3"])


# ---------------------------------------------------------------- mini-batches
def test_draws_repeat_and_differ(spark):
    df, *_ = points(spark, n=500, d=2)
    ids = lambda it, f=0.3, d=df: {r.point_id for r in drawn(d, f, 42, it, "point_id").collect()}
    assert ids(1) == ids(1, d=df.repartition(7)) != ids(2)
    assert 100 < len(ids(1)) < 200 and ids(3, 0.0) == set() and len(ids(3, 1.0)) == 500
    with pytest.raises(ValueError):
        ids(1, 0.33333)


def test_mini_batch_run_equals_numpy(spark):
    df, x, y, _ = points(spark, n=300, d=3)
    r = sgd_rowwise(df, 3, 6, 0.5, 0.1, True, tol=0.0, mini_batch_fraction=0.2, id_col="point_id")
    w = np.array([0.0, 0.0, 0.0, 1.0])
    z = np.hstack([x, np.ones((300, 1))])
    for i in range(1, 7):
        on = sorted(v.point_id for v in drawn(df, 0.2, 42, i, "point_id").collect())
        t = 0.5 / np.sqrt(i)
        w = w * (1 - t * 0.1) - t * z[on].T @ (z[on] @ w - y[on]) / len(on)
    assert np.allclose(np.append(r.weights, r.intercept), w)


# ---------------------------------------------------------------- stored splits and models
def test_stored_split_reads_its_own_files(spark):
    p = Pipeline.from_fixture(spark, SF001, "signal").store()
    path = p._stored.removeprefix("file:")
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["split=test", "split=train", "split=validation"]
    plan = p.split("validation")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "= validation)]" in plan and "md5" not in plan
    fresh = Pipeline.from_fixture(spark, SF001, "signal")
    for s in ("train", "validation", "test"):
        assert p.split(s).count() == fresh.split(s).count()
    assert np.allclose(p.sgd().weights, fresh.sgd().weights)
    assert p.store() is p
    p.release()
    assert not os.path.exists(path)
    assert p.split("test").count() == fresh.split("test").count()  # from the source again


def test_stored_empty_split(spark):
    df, *_ = points(spark, n=5, d=2)
    p = Pipeline(spark, df.drop("split").limit(0), 2).store()
    assert p.split("train").count() == 0
    p.release()


def test_models_come_back(spark, tmp_path):
    models = {"c": ConstantModel("c", 2.5), "a": LinearModel("a", np.array([1.0, -2.0]), 0.25, 2),
              "x": LinearModel("x", np.arange(6.0), 0.0, 2, True)}
    path = str(tmp_path / "models")
    save_models(spark, models, 2, path)
    stored = spark.read.parquet(path)
    back = load_models(stored)
    assert list(back) == ["a", "c", "x"]
    assert back["a"].intercept == 0.25 and list(back["a"].weights) == [1.0, -2.0]
    assert back["c"].intercept == 2.5 and list(back["c"].weights) == [0.0, 0.0]
    assert back["x"].interactions and list(back["x"].weights) == list(range(6))
    with pytest.raises(ValueError):
        load_models(stored.union(stored))
    assert load_models(stored.limit(0)) == {}


# ---------------------------------------------------------------- counts beside training
def test_bad_lines_are_counted_in_the_training_pass(spark):
    lines = mixed_lines(spark, SF001)
    (model, counts), jobs = _jobs(spark, lambda: reports.train_permissive(lines, 3))
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    items = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert counts == {"n_lines": docs + items, "n_bad": docs} and docs > 0
    # every job is a stage of the one query over the moments (adaptive execution submits each of its shuffles)
    points_, seen = observed_points(lines, 3)
    rows = points_.select(F.lit("all").alias("split"), "label", "features")
    plan = moments_frame(rows, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2 and plan.count("CollectMetrics") == 1  # lineitem and documents, once each
    assert jobs <= 3
    m = Pipeline(spark, points_, 3)
    assert len(model.weights) == m.d


def test_all_lines_bad(spark):
    model, counts = reports.train_permissive(spark.createDataFrame([("x",), (None,), ("",)], "value string"), 3)
    assert counts == {"n_lines": 3, "n_bad": 3} and list(model.weights) == [0.0, 0.0, 0.0]


# ---------------------------------------------------------------- ML vectors
def test_ml_vectors(spark):
    from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
    df, x, *_ = points(spark, n=6, d=3, parts=1)
    v = df.select("point_id", to_ml_vector("features").alias("v"))
    assert v.schema["v"].dataType == VectorUDT()
    for r in v.collect():
        assert isinstance(r.v, DenseVector) and np.allclose(r.v.toArray(), x[r.point_id])
    back = {r.point_id: r.f for r in v.select("point_id", from_ml_vector("v").alias("f")).collect()}
    assert all(np.allclose(back[k], x[k]) for k in back)
    sparse = spark.createDataFrame([(SparseVector(3, {1: 2.0}),)], ["v"])
    assert sparse.select(from_ml_vector("v").alias("f")).first().f == [0.0, 2.0, 0.0]
    rep = {(r.split, r.feature): r for r in reports.vector_summary(df).collect()}
    tr = np.array([k % 5 > 0 for k in range(6)])
    assert rep["train", 1].mean == pytest.approx(x[tr][:, 1].mean()) and rep["train", 1].variance == pytest.approx(x[tr][:, 1].var(ddof=1))
    assert rep["train", 1].n == tr.sum()


def test_entry_without_the_training_part(monkeypatch):
    """A library that only the training-data part needs may be missing."""
    import builtins
    import importlib
    real = builtins.__import__

    def missing(name, *a, **k):
        if name == "public_tokenizers":
            raise ModuleNotFoundError("No module named 'public_tokenizers'", name="public_tokenizers")
        return real(name, *a, **k)
    import sys
    for m in [m for m in sys.modules if m.startswith(("linfold.llm", "corpus_pipeline", "public_tokenizers"))]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(builtins, "__import__", missing)
    try:
        entry = importlib.reload(E)
        assert not any(k.startswith("op") for k in entry.queries()) and len(entry.queries()) >= 80
    finally:
        monkeypatch.undo()
        importlib.reload(E)
