"""Report tables: plot data (V1-V5), moments, interactions (M11, M12) and
the model comparison (M13)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.vectors import dot, from_ml_vector, to_ml_vector
from linfold.operators.aggregates import tree_agg
from linfold.operators.descent import gradient_descent
from linfold.operators.features import add_interactions, explode_features, min_max_scale
from linfold.operators.moments import Moments, collect_moments, collect_moments_and_min, moments_frame
from linfold.operators.models import LinearModel
from linfold.plans import oracle as O
from linfold.plans.pipeline import (
    GD_ITERATIONS, GD_L2_ETA, INTERACT_REG, SGD_ITERATIONS, SGD_STEP, Pipeline,
)
from linfold.operators.tiles import tile_report, tiled_moments
from linfold.sources.text import observed_points, parse_points, parse_report


INTERACT_EMBED_STEP = 0.1
# 64 features and 4,096 products: the row path; at this step the first iterations don't amplify
INTERACT_FULL_STEP, INTERACT_FULL_ITERATIONS = 0.001, 15


def label_histograms(points: DataFrame) -> DataFrame:
    """V2: points per label before and after the shift, tagged by ``kind``."""
    from linfold.operators.metrics import label_histogram, shifted_label_histogram
    a = label_histogram(points).select(F.lit("original").alias("kind"), "label", "n")
    b = shifted_label_histogram(points).select(F.lit("shifted").alias("kind"), "label", "n")
    return a.unionByName(b)


def feature_heatmap(points: DataFrame, k: int = 50) -> DataFrame:
    """First ``k`` points by id, long form ``(point_id, feature, value)``."""
    from linfold.operators.sampling import first_k
    first = first_k(points, k)
    out = explode_features(first)
    return out.select("point_id", F.col("feature").cast("bigint"),
                      (F.round("value", 9) + F.lit(0.0)).alias("value"))


def gradient_sum(p: Pipeline, weights: Sequence[float], split: str = "train") -> DataFrame:
    """Sum over a split of ``(w.x - y) x``, reported per feature, also as a mean."""
    d = len(weights)
    err = dot("features", weights) - F.col("label")
    specs = [(f"g{k}", "sum", err * F.col("features").getItem(k)) for k in range(d)]
    agg = tree_agg(p.split(split), [], [("n", "count", F.lit(1)), *specs], p.fanout)
    rows = F.posexplode(F.array(*[F.col(f"g{k}") for k in range(d)])).alias("feature", "gradient")
    return agg.select("n", rows).select(F.col("feature").cast("bigint"), "gradient",
                                        (F.col("gradient") / F.col("n")).alias("mean_gradient"))


def moment_terms(d: int) -> list[str]:
    return (["n", "y", "yy"] + [f"x{k}" for k in range(d)] + [f"xy{k}" for k in range(d)]
            + [f"xx{i}_{j}" for i in range(d) for j in range(i, d)])


def moments_table(p: Pipeline, interactions: bool = False) -> DataFrame:
    """``(split, term, value)``: n itself, every other moment divided by n.

    The moments come from the pipeline's single pass (which also resolves
    the label shift); the O(D^2) numbers per split become a small frame.
    Empty splits have no rows."""
    width = p.width(interactions)
    names = moment_terms(width)
    iu = np.triu_indices(width)
    rows = []
    for split, m in sorted(p.moments(interactions).items()):
        if m.n == 0:
            continue
        vals = [m.sy, m.syy, *m.sx, *m.xty, *m.xtx[iu]]
        rows.append((split, names[0], float(m.n)))
        rows.extend((split, t, float(v) / m.n) for t, v in zip(names[1:], vals))
    return p.spark.createDataFrame(rows, "split string, term string, value double")


def trace_table(spark: SparkSession, trace: np.ndarray) -> DataFrame:
    """V4/V5: ``(iteration, rmse, ln_rmse, scaled_ln_rmse)`` rounded to 6 decimals."""
    rows = [(int(i), float(v)) for i, v in enumerate(trace)]
    schema = T.StructType([T.StructField("iteration", T.LongType()),
                           T.StructField("rmse", T.DoubleType())])
    df = spark.createDataFrame(rows, schema).withColumn("ln_rmse", F.log("rmse"))
    df = min_max_scale(df, "ln_rmse", "scaled_ln_rmse")
    r6 = lambda c: F.round(c, 6) + F.lit(0.0)
    return df.select("iteration", r6("rmse").alias("rmse"), r6("ln_rmse").alias("ln_rmse"),
                     r6("scaled_ln_rmse").alias("scaled_ln_rmse"))


def gd_small(p: Pipeline, n: int = 10, k: int = 3, iters: int = 5, eta: float = 0.0, alpha: float = 1.0) -> DataFrame:
    """Descent on the first ``n`` training points (by id), first ``k`` features."""
    from linfold.operators.sampling import first_k
    small = first_k(p.split("train"), n)
    small = small.withColumn("features", F.slice("features", 1, k))
    m = collect_moments(moments_frame(small, k, fanout=1)).get("train", Moments.empty(k))
    w, _ = gradient_descent(m, iters, alpha, eta)
    model = LinearModel("small", w, 0.0, k)
    spark = p.spark
    return model.weights_frame(spark).select("feature", (F.round("weight", 6) + F.lit(0.0)).alias("weight"))


def train_permissive(lines: DataFrame, d: int, iters: int = GD_ITERATIONS, alpha: float = 1.0) -> tuple[LinearModel, dict]:
    """The plain descent on the good lines among ``lines`` and ``{n_lines, n_bad}``,
    in one pass: the moments, the minimum label that they are shifted by, and the
    counts of the parse, which ride along (``DataFrame.observe``)."""
    points, seen = observed_points(lines, d)
    rows = points.select(F.lit("all").alias("split"), "label", F.col("label").alias("_label_raw"), "features")
    got, lo = collect_moments_and_min(moments_frame(rows, d, min_of="_label_raw"))
    if got:
        m, counts = got["all"].shifted(-lo), seen.get
    else:  # no good line: the plan ends before its counts, which are then taken by themselves
        m, all_bad = Moments.empty(d), parse_report(parse_points(lines, mode="permissive", expected_width=d)).first()
        counts = {k: all_bad[k] for k in ("n_lines", "n_bad")}
    w, _ = gradient_descent(m, iters, alpha)
    return LinearModel("permissive", w, 0.0, d), counts


def vector_summary(points: DataFrame, by: str = "split") -> DataFrame:
    """``(by, feature, n, mean, variance)`` by the ML library's own summary of a
    vector column; one partial summary per task and group."""
    from pyspark.ml.stat import Summarizer
    vectors = points.select(by, to_ml_vector("features").alias("vector"))
    got = vectors.groupBy(by).agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("vector")).alias("s"))
    pairs = F.arrays_zip(from_ml_vector("s.mean").alias("mean"), from_ml_vector("s.variance").alias("variance"))
    return got.select(by, F.col("s.count").alias("n"), F.posexplode(pairs).alias("feature", "p")) \
        .select(by, F.col("feature").cast("bigint").alias("feature"), "n", "p.mean", "p.variance")


def model_report(p: Pipeline, with_interactions: bool = True) -> DataFrame:
    """``(split, model, rmse)``: the baseline on every split, each model on
    validation, the interaction model also on test.

    Two passes over the rows: the interaction moments (which contain the
    base moments) and one scoring pass that scores every model at once,
    grid trials included; the grid winner is picked from that pass's
    few-row result."""
    from linfold.plans.search import grid_trials, held, pick_best
    if with_interactions:
        p.moments(True)
    lr0, _ = p.gd(GD_ITERATIONS, 1.0, 0.0, name="LR0")
    l2, _ = p.gd(GD_ITERATIONS, 1.0, GD_L2_ETA, name="RegularizedLR")
    trial_regs, trials = grid_trials(p)  # trial 0 is LR1 (the incumbent)
    models = {"Baseline": p.baseline(), "LR0": lr0, "RegularizedLR": l2}
    models.update({f"trial{t}": m for t, m in trials.items()})
    if with_interactions:
        models["LRInteract"] = p.sgd(SGD_ITERATIONS, SGD_STEP, INTERACT_REG, True,
                                     interactions=True, name="LRInteract")
    scored = held(p.score(models))
    val = {int(r["model"][5:]): r["rmse"] for r in
           scored.where((F.col("split") == "validation") & F.col("model").startswith("trial"))
           .select("model", "rmse").collect()}
    best = pick_best(val, len(trial_regs))
    model, split = F.col("model"), F.col("split")
    plain = scored.where((model == "Baseline")
                         | ((split == "validation") & model.isin("LR0", "RegularizedLR", "trial0"))
                         | ((model == "LRInteract") & split.isin("validation", "test")))
    plain = plain.select("split", F.when(model == "trial0", F.lit("LR1")).otherwise(model)
                         .alias("model"), "rmse")
    grid = scored.where((split == "validation") & (model == F.lit(f"trial{best}"))) \
        .select("split", F.lit("LRGrid").alias("model"), "rmse")
    return plain.unionByName(grid)


def report_lines(report: DataFrame) -> DataFrame:
    """Printable lines ``<model> RMSE (<split>) = <rmse to 3 decimals>``."""
    return report.select("split", "model", F.format_string("%s RMSE (%s) = %.3f", F.col("model"),
                                                            F.col("split"), F.col("rmse")).alias("line"))


def trace_tail(spark: SparkSession, trace: np.ndarray, start: int = 6) -> DataFrame:
    """The trace from iteration ``start`` on, min-max scaled over that tail."""
    rows = [(int(i), float(v)) for i, v in enumerate(trace) if i >= start]
    schema = T.StructType([T.StructField("iteration", T.LongType()),
                           T.StructField("rmse", T.DoubleType())])
    df = min_max_scale(spark.createDataFrame(rows, schema), "rmse", "scaled_rmse")
    return df.select("iteration", (F.round("rmse", 6) + F.lit(0.0)).alias("rmse"),
                     (F.round("scaled_rmse", 6) + F.lit(0.0)).alias("scaled_rmse"))


# ---------------------------------------------------------------- query registrations
def queries(r6):
    out = {}

    def reg(name, sql):
        def deco(fn):
            out[name] = (fn, sql)
            return fn
        return deco

    d = O.WIDTH["signal"]
    zi = O.z_names(d, True)
    zb = O.z_names(d, False)

    @reg("interactions", O.with_(O.raw_cte("signal"), O.zp_cte(d, True, src="raw")) + (
        "SELECT point_id, CAST(generate_subscripts(zl, 1) - 1 AS BIGINT) AS feature,"
        " round(unnest(zl), 9) + 0.0 AS value FROM (SELECT point_id, [" + ", ".join(zi)
        + "] AS zl FROM zp)"))
    def _interactions(spark, sf_dir):
        from linfold.sources.fixtures import signal_points
        pts = add_interactions(signal_points(spark, sf_dir), d)
        out = explode_features(pts)
        return out.select("point_id", F.col("feature").cast("bigint"),
                          (F.round("value", 9) + F.lit(0.0)).alias("value"))

    ibase = O.with_(O.pts_cte("signal"), O.zp_cte(d, True), O.mom_cte(zi, True),
                    O.sgd_ctes(len(zi), [(0, INTERACT_REG, SGD_STEP, SGD_ITERATIONS)]))

    @reg("interact_weights", ibase + (
        "SELECT CAST(CASE WHEN k > " + str(len(zi)) + " THEN -1 ELSE k - 1 END AS BIGINT) AS feature,"
        f" {O.r6('w[k]')} AS weight, CAST(iters_run AS BIGINT) AS iterations"
        " FROM (SELECT w, iters_run, generate_subscripts(w, 1) AS k FROM sgd_fin)"))
    def _iw(spark, sf_dir):
        p = Pipeline.from_fixture(spark, sf_dir, "signal")
        m = p.sgd(SGD_ITERATIONS, SGD_STEP, INTERACT_REG, True, interactions=True, name="LRInteract")
        return m.weights_frame(spark).select("feature", r6("weight").alias("weight"),
                                             F.lit(int(m.info["iterations"])).cast("bigint").alias("iterations"))

    mean = "(SELECT avg(label) FROM pts WHERE split = 'train')"
    predi = O.predict_expr("f.w", zi, True)

    @reg("interact_rmse", ibase + (
        f"SELECT split, 'Baseline' AS model, {O.r6(f'sqrt(avg(pow(label - {mean}, 2)))')} AS rmse"
        " FROM zp WHERE split <> 'train' GROUP BY split UNION ALL "
        f"SELECT split, 'LRInteract' AS model, {O.r6(f'sqrt(avg(pow(label - {predi}, 2)))')} AS rmse"
        " FROM zp CROSS JOIN sgd_fin f WHERE split <> 'train' GROUP BY split"))
    def _ir(spark, sf_dir):
        p = Pipeline.from_fixture(spark, sf_dir, "signal")
        m = p.sgd(SGD_ITERATIONS, SGD_STEP, INTERACT_REG, True, interactions=True, name="LRInteract")
        sc = p.score({"Baseline": p.baseline(), "LRInteract": m}, ["validation", "test"])
        return sc.select("split", "model", r6("rmse").alias("rmse"))

    for sp, qname in (("validation", "interact_val_rmse"), ("test", "interact_test_rmse")):
        def _one(spark, sf_dir, sp=sp):
            p = Pipeline.from_fixture(spark, sf_dir, "signal")
            m = p.sgd(SGD_ITERATIONS, SGD_STEP, INTERACT_REG, True, interactions=True, name="LRInteract")
            sc = p.score({"Baseline": p.baseline(), "LRInteract": m}, [sp])
            return sc.select("model", r6("rmse").alias("rmse"))
        reg(qname, ibase + (
            f"SELECT 'Baseline' AS model, {O.r6(f'sqrt(avg(pow(label - {mean}, 2)))')} AS rmse"
            f" FROM zp WHERE split = '{sp}' UNION ALL "
            f"SELECT 'LRInteract' AS model, {O.r6(f'sqrt(avg(pow(label - {predi}, 2)))')} AS rmse"
            f" FROM zp CROSS JOIN sgd_fin f WHERE split = '{sp}'"))(_one)

    # 12 features -> 156. Step 1 passes through a blow-up on this fixture, where
    # rounding decides the end; step 0.1 is stable.
    de = O.WIDTH["embed"]
    zei = O.z_names(de, True)
    ebase = O.with_(O.pts_cte("embed"), O.zp_cte(de, True), O.mom_cte_symmetric(zei),
                    O.sgd_ctes(len(zei), [(0, INTERACT_REG, INTERACT_EMBED_STEP, SGD_ITERATIONS)]))
    prede = O.predict_expr("f.w", zei, True)

    @reg("interact_embed", ebase + (
        f"SELECT split, CAST(f.iters_run AS BIGINT) AS iterations_run, CAST({len(zei)} AS BIGINT) AS width,"
        f" {O.r6(f'sqrt(avg(pow(label - {prede}, 2)))')} AS rmse"
        " FROM zp CROSS JOIN sgd_fin f GROUP BY split, f.iters_run"))
    def _ie(spark, sf_dir):
        p = Pipeline.from_fixture(spark, sf_dir, "embed")
        m = p.sgd(SGD_ITERATIONS, INTERACT_EMBED_STEP, INTERACT_REG, True, interactions=True, name="LRInteract")
        return p.score({"LRInteract": m}).select(
            "split", F.lit(int(m.info["iterations"])).cast("bigint").alias("iterations_run"),
            F.lit(len(m.weights)).cast("bigint").alias("width"), r6("rmse").alias("rmse"))

    @reg("moments_interact_embed", O.moments_sql("embed", True))
    def _mie(spark, sf_dir):
        return moments_table(Pipeline.from_fixture(spark, sf_dir, "embed"), True) \
            .select("split", "term", r6("value").alias("value"))

    @reg("moments_embed64", O.moments_sql("embed64"))
    def _m64(spark, sf_dir):
        return moments_table(Pipeline.from_fixture(spark, sf_dir, "embed64")) \
            .select("split", "term", r6("value").alias("value"))

    # ---- 4,160 terms: all two-way products of the stored dimensions, never formed for a row
    df = O.WIDTH["embed64"]

    @reg("interact_embed64", O.interact_by_kernel_sql(df, INTERACT_REG, INTERACT_FULL_STEP, INTERACT_FULL_ITERATIONS))
    def _ie64(spark, sf_dir):
        p = Pipeline.from_fixture(spark, sf_dir, "embed64")
        m = p.sgd(INTERACT_FULL_ITERATIONS, INTERACT_FULL_STEP, INTERACT_REG, True, interactions=True, name="LRInteract", tol=0.0)
        return p.score({"LRInteract": m}).select(
            "split", F.lit(int(m.info["iterations"])).cast("bigint").alias("iterations_run"),
            F.lit(len(m.weights)).cast("bigint").alias("width"), r6("rmse").alias("rmse"))

    # the 1,056 x 1,056 moments of 32 dimensions and their products, by tile
    dt = 32
    base32 = "[" + ", ".join(f"f{k}" for k in range(dt)) + "]"

    @reg("moments_tiled", O.with_(
        O.pts_cte("embed64"),
        "z AS (SELECT split, label, list_concat(f, flatten(list_transform(f, lambda a: list_transform(f, lambda b: a * b)))) AS z"
        f" FROM (SELECT split, label, {base32} AS f FROM pts))",
        "zl AS (SELECT *, list_sum(z) AS total FROM z)")
         + ("SELECT split, CAST(k - 1 AS BIGINT) AS feature, " + O.r6("sum(v * total) / count(*)") + " AS row_mean, "
            + O.r6("sum(v * v) / count(*)") + " AS square_mean, " + O.r6("sum(v * label) / count(*)") + " AS label_mean"
            " FROM (SELECT split, label, total, unnest(z) AS v, generate_subscripts(z, 1) AS k FROM zl) GROUP BY split, k"))
    def _mt(spark, sf_dir):
        p = Pipeline.from_fixture(spark, sf_dir, "embed64")
        rows = p.data.withColumn("features", F.slice("features", 1, dt))
        sizes = p.data.groupBy("split").count()
        mean = lambda c: r6(F.col(c) / F.col("count"))
        return tile_report(tiled_moments(rows, dt, interactions=True), dt, interactions=True).join(sizes, "split").select(
            "split", "feature", mean("row_sum").alias("row_mean"), mean("square_sum").alias("square_mean"), mean("label_sum").alias("label_mean"))

    # ---- model report
    from linfold.plans.search import _grid_sql_parts
    gbase, _ = _grid_sql_parts("signal")
    rep_ctes = gbase.rstrip("\n") + ",\n" + ",\n".join([
        O.mom_cte(zb, False, name="mom0"),
        O.gd_ctes(d, GD_ITERATIONS, 1.0, 0.0, mom="mom0", name="gd"),
        O.gd_ctes(d, GD_ITERATIONS, 1.0, GD_L2_ETA, mom="mom0", name="gdl2"),
        O.zp_cte(d, True, name="zpi"),
        O.mom_cte(zi, True, src="zpi", name="momi"),
        O.sgd_ctes(len(zi), [(0, INTERACT_REG, SGD_STEP, SGD_ITERATIONS)], mom="momi", name="si"),
    ]) + "\n"
    rep_union = " UNION ALL ".join([
        f"SELECT split, 'Baseline' AS model, {O.r6(f'sqrt(avg(pow(label - {mean}, 2)))')} AS rmse"
        " FROM zp GROUP BY split",
        f"SELECT split, 'LR0' AS model, {O.r6('sqrt(avg(pow(label - ' + O.predict_expr('g.w', zb, False) + ', 2)))')}"
        f" AS rmse FROM zp CROSS JOIN (SELECT w FROM gd WHERE i = {GD_ITERATIONS}) g"
        " WHERE split = 'validation' GROUP BY split",
        f"SELECT split, 'RegularizedLR' AS model, {O.r6('sqrt(avg(pow(label - ' + O.predict_expr('g.w', zb, False) + ', 2)))')}"
        f" AS rmse FROM zp CROSS JOIN (SELECT w FROM gdl2 WHERE i = {GD_ITERATIONS}) g"
        " WHERE split = 'validation' GROUP BY split",
        f"SELECT 'validation' AS split, 'LR1' AS model, {O.r6('rmse')} AS rmse FROM gscore WHERE trial = 0",
        f"SELECT 'validation' AS split, 'LRGrid' AS model, {O.r6('rmse')} AS rmse FROM gscore"
        " WHERE trial = (SELECT trial FROM gbest)",
        f"SELECT split, 'LRInteract' AS model, {O.r6('sqrt(avg(pow(label - ' + O.predict_expr('f.w', zi, True) + ', 2)))')}"
        " AS rmse FROM zpi CROSS JOIN si_fin f WHERE split <> 'train' GROUP BY split",
    ])

    @reg("model_report", rep_ctes + rep_union)
    def _report(spark, sf_dir):
        rep = model_report(Pipeline.from_fixture(spark, sf_dir, "signal"))
        return rep.select("split", "model", r6("rmse").alias("rmse"))

    @reg("report_lines", rep_ctes + "SELECT split, model, printf('%s RMSE (%s) = %.3f', model, split,"
         " rmse) AS line FROM (" + rep_union + ")")
    def _lines(spark, sf_dir):
        rep = model_report(Pipeline.from_fixture(spark, sf_dir, "signal"))
        return report_lines(rep.withColumn("rmse", r6("rmse")))

    return out
