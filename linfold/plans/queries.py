"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the test tables. Values
are rounded to 6 decimals (plus 0.0 against negative zero) on both sides,
because the two engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.operators.features import explode_features, label_range, shift_labels, slice_features
from linfold.operators.metrics import label_histogram, residuals
from linfold.operators.models import ideal_prediction
from linfold.operators.sampling import first_k
from linfold.operators.splits import hash_split, random_split, split_sizes
from linfold.plans import oracle as O
from linfold.plans import reports, search
from linfold.plans.pipeline import (
    GD_ITERATIONS, GD_L2_ETA, Pipeline,
)
from linfold.sources.fixtures import (
    embed_points, embed_points_full, embed_text_points, mixed_lines, signal_points,
)
from linfold.sources.text import feature_width, parse_points, parse_report

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def r9(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 9) + F.lit(0.0)


def s9(x: str) -> str:
    return f"(round({x}, 9) + 0.0)"


def _fl(d: int) -> str:
    return "[" + ", ".join(f"f{k}" for k in range(d)) + "]"


def _long_sql(src: str, d: int, keys: str = "point_id", extra: str = "") -> str:
    return (f"SELECT {keys}{extra}, CAST(generate_subscripts(fl, 1) - 1 AS BIGINT) AS feature,"
            f" {s9('unnest(fl)')} AS value FROM (SELECT *, {_fl(d)} AS fl FROM {src})")


def _long(df: DataFrame, keys=("point_id",)) -> DataFrame:
    out = explode_features(df, keys)
    return out.select(*keys, F.col("feature").cast("bigint").alias("feature"), r9("value").alias("value"))


def _pipe(spark, sf_dir, fixture="signal") -> Pipeline:
    return Pipeline.from_fixture(spark, sf_dir, fixture)


# ---------------------------------------------------------------- sources
_E = O.WIDTH["embed64"]


@register("parse_points", O.with_(O.raw_cte("embed64")) +
          "SELECT label, " + ", ".join(f"{s9(f'f{k}')} AS f{k}" for k in range(_E)) + " FROM raw")
def q_parse_points(spark, sf_dir):
    pts = embed_text_points(spark, sf_dir)
    return pts.select("label", *[r9(F.col("features").getItem(k)).alias(f"f{k}") for k in range(_E)])


@register("parse_permissive", O.with_(
    O.raw_cte("signal"),
    "lines AS (SELECT concat_ws(',', label, f0, f1, f2) AS value FROM raw"
    " UNION ALL SELECT text AS value FROM documents)",
    "parsed AS (SELECT TRY_CAST(toks[1] AS DOUBLE) AS label,"
    " list_transform(toks[2:], lambda t: TRY_CAST(t AS DOUBLE)) AS feats"
    " FROM (SELECT string_split(value, ',') AS toks FROM lines))",
    "flagged AS (SELECT *, coalesce(NOT (label IS NULL OR list_bool_or(list_transform(feats,"
    " lambda x: x IS NULL)) OR len(feats) <> 3), false) AS ok FROM parsed)") +
    "SELECT count(*) AS n_lines, count(*) FILTER (WHERE ok) AS n_parsed,"
    " count(*) FILTER (WHERE NOT ok) AS n_bad, CAST(min(len(feats)) FILTER (WHERE ok) AS BIGINT)"
    " AS min_width, CAST(max(len(feats)) FILTER (WHERE ok) AS BIGINT) AS max_width FROM flagged")
def q_parse_permissive(spark, sf_dir):
    rep = parse_report(parse_points(mixed_lines(spark, sf_dir), mode="permissive", expected_width=3))
    return rep.select("n_lines", "n_parsed", "n_bad", F.col("min_width").cast("bigint"),
                      F.col("max_width").cast("bigint"))


_PARSED = O.with_(
    O.raw_cte("signal"),
    "bad AS (SELECT count(*) AS n FROM documents WHERE NOT coalesce(len(string_split(text, ',')) = 4"
    " AND list_bool_and(list_transform(string_split(text, ','), lambda t: TRY_CAST(t AS DOUBLE) IS NOT NULL)), false))",
    "pts AS (SELECT *, 'train' AS split FROM (SELECT f0, f1, f2, label - (SELECT min(label) FROM raw) AS label FROM raw))",
    O.zp_cte(3, False), O.mom_cte(O.z_names(3, False), False),
    O.gd_ctes(3, GD_ITERATIONS, 1.0, 0.0), f"fw AS (SELECT w FROM gd WHERE i = {GD_ITERATIONS})")


@register("train_permissive", _PARSED + (
    "SELECT CAST((SELECT count(*) FROM lineitem) + (SELECT count(*) FROM documents) AS BIGINT) AS n_lines,"
    " (SELECT n FROM bad) AS n_bad, CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS feature,"
    f" {O.r6('unnest(w)')} AS weight FROM fw"))
def q_train_permissive(spark, sf_dir):
    model, counts = reports.train_permissive(mixed_lines(spark, sf_dir), 3, GD_ITERATIONS)
    return model.weights_frame(spark).select(
        F.lit(counts["n_lines"]).cast("bigint").alias("n_lines"), F.lit(counts["n_bad"]).cast("bigint").alias("n_bad"),
        "feature", r6("weight").alias("weight"))


@register("ml_vectors", O.with_(O.raw_cte("embed64")) + _long_sql("raw", _E))
def q_ml_vectors(spark, sf_dir):
    from linfold.functions.vectors import from_ml_vector, to_ml_vector
    vectors = embed_points_full(spark, sf_dir).select("point_id", to_ml_vector("features").alias("vector"))
    return _long(vectors.select("point_id", from_ml_vector("vector").alias("features")))


@register("ml_vector_summary", O.with_(O.pts_cte("signal")) + (
    "SELECT split, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS feature, n,"
    f" {O.r6('unnest(m)')} AS mean, {O.r6('unnest(v)')} AS variance FROM (SELECT split, count(*) AS n,"
    " [avg(f0), avg(f1), avg(f2)] AS m, [var_samp(f0), var_samp(f1), var_samp(f2)] AS v FROM pts GROUP BY split)"))
def q_ml_vector_summary(spark, sf_dir):
    return reports.vector_summary(_pipe(spark, sf_dir).unshifted) \
        .select("split", "feature", "n", r6("mean").alias("mean"), r6("variance").alias("variance"))


@register("feature_width",
          "SELECT count(*) AS n, CAST(min(len(embedding)) AS BIGINT) AS min_width,"
          " CAST(max(len(embedding)) AS BIGINT) AS max_width,"
          " min(len(embedding)) = max(len(embedding)) AS consistent FROM embeddings")
def q_feature_width(spark, sf_dir):
    fw = feature_width(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding")
    return fw.select("n", F.col("min_width").cast("bigint"), F.col("max_width").cast("bigint"),
                     "consistent")


# ---------------------------------------------------------------- labels
@register("label_range", O.with_(O.raw_cte("signal")) +
          "SELECT min(label) AS min_label, max(label) AS max_label FROM raw")
def q_label_range(spark, sf_dir):
    return label_range(signal_points(spark, sf_dir))


@register("shift_labels", O.with_(O.pts_cte("signal")) +
          "SELECT point_id, label_raw, label FROM pts")
def q_shift_labels(spark, sf_dir):
    return shift_labels(signal_points(spark, sf_dir), keep_raw=True) \
        .select("point_id", "label_raw", "label")


@register("label_hist", O.with_(O.raw_cte("signal")) +
          "SELECT label, count(*) AS n FROM raw GROUP BY label")
def q_label_hist(spark, sf_dir):
    return label_histogram(signal_points(spark, sf_dir))


@register("label_hist_shifted", O.with_(O.pts_cte("signal")) +
          "SELECT label, count(*) AS n FROM pts GROUP BY label")
def q_label_hist_shifted(spark, sf_dir):
    return label_histogram(shift_labels(signal_points(spark, sf_dir)))


# ---------------------------------------------------------------- samples, slices
@register("sample_first_k", O.with_(O.raw_cte("embed64"),
                                    "firstk AS (SELECT * FROM raw ORDER BY point_id LIMIT 5)") +
          _long_sql("firstk", _E, extra=", label"))
def q_sample_first_k(spark, sf_dir):
    first = first_k(embed_points_full(spark, sf_dir), 5)
    return _long(first, ("point_id", "label"))


@register("feature_slice", O.with_(O.raw_cte("embed")) + _long_sql("raw", 3))
def q_feature_slice(spark, sf_dir):
    return _long(slice_features(embed_points(spark, sf_dir), 3))


@register("feature_heatmap", O.with_(O.raw_cte("embed64"),
                                     "firstk AS (SELECT * FROM raw ORDER BY point_id LIMIT 50)") +
          _long_sql("firstk", _E))
def q_feature_heatmap(spark, sf_dir):
    return reports.feature_heatmap(embed_points_full(spark, sf_dir), 50)


# ---------------------------------------------------------------- splits
def _split_sizes_sql(fx):
    return O.with_(O.pts_cte(fx)) + (
        "SELECT split, count(*) AS n, (SELECT count(*) FROM pts) AS total,"
        " sum(count(*)) OVER () = (SELECT count(*) FROM pts) AS sizes_add_up FROM pts GROUP BY split")


@register("split_sizes", _split_sizes_sql("signal"))
def q_split_sizes(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return split_sizes(p.unshifted, fanout=p.fanout)


@register("split_sizes_embed", _split_sizes_sql("embed"))
def q_split_sizes_embed(spark, sf_dir):
    # sizes need ids only: no feature range is read
    ids = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("point_id"))
    return split_sizes(hash_split(ids))


@register("random_split_sizes", O.with_(O.raw_cte("signal")) + (
    "SELECT unnest(['train', 'validation', 'test']) AS split, count(*) AS total,"
    " true AS sizes_add_up, true AS near_weight FROM raw"))
def q_random_split_sizes(spark, sf_dir):
    # Membership depends on partitioning, so what is compared is what any seed
    # must give: sizes that add up, each within 5 sigma of its weight.
    p = _pipe(spark, sf_dir)
    sizes = split_sizes(random_split(p.points), fanout=p.fanout)
    weight = F.when(F.col("split") == "train", 0.8).otherwise(0.1)
    sigma = F.sqrt(F.col("total") * weight * (1 - weight))
    return sizes.select("split", "total", "sizes_add_up",
                        (F.abs(F.col("n") - F.col("total") * weight) <= 5 * sigma).alias("near_weight"))


@register("split_assign", O.with_(O.pts_cte("signal")) + "SELECT point_id, split FROM pts")
def q_split_assign(spark, sf_dir):
    return _pipe(spark, sf_dir).unshifted.select("point_id", "split")


# ---------------------------------------------------------------- baseline
_SIG = O.with_(O.pts_cte("signal"))
_MEAN = "(SELECT avg(label) FROM pts WHERE split = 'train')"


@register("train_mean", _SIG + f"SELECT {O.r6('avg(label)')} AS train_mean FROM pts WHERE split = 'train'")
def q_train_mean(spark, sf_dir):
    return _pipe(spark, sf_dir).train_mean().select(r6("train_mean").alias("train_mean"))


@register("baseline_rmse", _SIG + f"SELECT split, {O.r6(f'sqrt(avg(pow(label - {_MEAN}, 2)))')}"
          " AS rmse FROM pts GROUP BY split")
def q_baseline_rmse(spark, sf_dir):
    from linfold.operators.metrics import constant_rmse
    p = _pipe(spark, sf_dir)
    # the error of a mean does not change with the label shift
    return constant_rmse(p.unshifted, fanout=p.fanout).select("split", r6("rmse").alias("rmse"))


def _resid_sql(pred: str, src_ctes: str, where: str = "split = 'validation'") -> str:
    return src_ctes + (
        f"SELECT point_id, {O.r6('label')} AS label, {O.r6('prediction')} AS prediction,"
        f" {O.r6('sq_error')} AS sq_error, {O.r6('CASE WHEN max(sq_error) OVER () = min(sq_error) OVER ()'
                                                  ' THEN 0.0 ELSE (sq_error - min(sq_error) OVER ())'
                                                  ' / (max(sq_error) OVER () - min(sq_error) OVER ()) END')}"
        " AS scaled_error FROM (SELECT point_id, label, prediction,"
        " (label - prediction) * (label - prediction) AS sq_error"
        f" FROM (SELECT *, {pred} AS prediction FROM zp WHERE {where}))")


def _resid(df: DataFrame, prediction: Column) -> DataFrame:
    out = residuals(df, prediction)
    return out.select("point_id", *[r6(c).alias(c) for c in
                                    ("label", "prediction", "sq_error", "scaled_error")])


_ZP3 = O.with_(O.pts_cte("signal"), O.zp_cte(3, False))


@register("residuals_ideal", _resid_sql("label", _ZP3))
def q_residuals_ideal(spark, sf_dir):
    return _resid(_pipe(spark, sf_dir).split("validation"), ideal_prediction())


@register("residuals_baseline", _resid_sql(_MEAN, _ZP3))
def q_residuals_baseline(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return _resid(p.baseline_predictions().where(F.col("split") == "validation"), F.col("prediction"))


# ---------------------------------------------------------------- gradient pieces
@register("gradient_sum", _SIG + (
    "SELECT CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS feature,"
    f" {O.r6('unnest(s) / n')} AS mean_gradient, round(unnest(s), 3) + 0.0 AS gradient FROM (SELECT count(*) AS n,"
    " [sum((f0 + f1 + f2 - label) * f0), sum((f0 + f1 + f2 - label) * f1),"
    " sum((f0 + f1 + f2 - label) * f2)] AS s FROM pts WHERE split = 'train')"))
def q_gradient_sum(spark, sf_dir):
    return reports.gradient_sum(_pipe(spark, sf_dir), [1.0, 1.0, 1.0]) \
        .select("feature", r6("mean_gradient").alias("mean_gradient"),
                (F.round("gradient", 3) + F.lit(0.0)).alias("gradient"))


@register("gradient_summand", _SIG + (
    "SELECT point_id, CAST(generate_subscripts(g, 1) - 1 AS BIGINT) AS feature,"
    f" {O.r6('unnest(g)')} AS summand FROM (SELECT point_id,"
    " [(f0 + f1 + f2 - label) * f0, (f0 + f1 + f2 - label) * f1,"
    " (f0 + f1 + f2 - label) * f2] AS g FROM pts WHERE split = 'train')"))
def q_gradient_summand(spark, sf_dir):
    from linfold.functions.vectors import gradient_summand
    train = _pipe(spark, sf_dir).split("train")
    g = train.select("point_id", gradient_summand("features", "label", [1.0, 1.0, 1.0]).alias("g"))
    out = g.select("point_id", F.posexplode("g").alias("feature", "summand"))
    return out.select("point_id", F.col("feature").cast("bigint"), r6("summand").alias("summand"))


@register("moments", O.moments_sql("signal"))
def q_moments(spark, sf_dir):
    return reports.moments_table(_pipe(spark, sf_dir)) \
        .select("split", "term", r6("value").alias("value"))


# ---------------------------------------------------------------- gradient descent (M2, M3)
# a step at which the descent on every stored dimension (64) is stable
FULL_ALPHA = 0.1


def _alpha(fx: str) -> float:
    return FULL_ALPHA if fx == "embed64" else 1.0


def _gd_ctes(fx: str, eta: float) -> str:
    """Points, moments (no intercept), the recursive descent ``gd`` and the
    final weights ``fw``."""
    d = O.WIDTH[fx]
    zs = O.z_names(d, False)
    return O.with_(O.pts_cte(fx), O.zp_cte(d, False), O.mom_cte(zs, False),
                   O.gd_ctes(d, GD_ITERATIONS, _alpha(fx), eta),
                   f"fw AS (SELECT w FROM gd WHERE i = {GD_ITERATIONS})")


_WEIGHTS_SELECT = ("SELECT CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS feature,"
                   f" {O.r6('unnest(w)')} AS weight FROM fw")


def _small_width(fx: str) -> int:
    """Features of the descent on ten points: three, or all of the full-width form."""
    return O.WIDTH[fx] if fx == "embed64" else 3


def _gd_sql(fx: str, eta: float, what: str) -> str:
    d = O.WIDTH[fx]
    zs = O.z_names(d, False)
    base = _gd_ctes(fx, eta)
    if what == "weights":
        return base + _WEIGHTS_SELECT
    if what == "trace":
        return base + (
            f"SELECT CAST(i AS BIGINT) AS iteration, {O.r6('rmse')} AS rmse,"
            f" {O.r6('ln(rmse)')} AS ln_rmse,"
            f" {O.r6('(ln(rmse) - min(ln(rmse)) OVER ()) / (max(ln(rmse)) OVER () - min(ln(rmse)) OVER ())')}"
            f" AS scaled_ln_rmse FROM gd WHERE i < {GD_ITERATIONS}")
    if what == "val":
        pred = O.predict_expr("fw.w", zs, False)
        return base + (
            f"SELECT 'Baseline' AS model, {O.r6(f'sqrt(avg(pow(label - {_MEAN}, 2)))')} AS rmse"
            " FROM zp WHERE split = 'validation' UNION ALL "
            f"SELECT '{'LR0' if eta == 0 else 'RegularizedLR'}' AS model,"
            f" {O.r6(f'sqrt(avg(pow(label - {pred}, 2)))')} AS rmse"
            " FROM zp CROSS JOIN fw WHERE split = 'validation'")
    if what == "small":
        k = _small_width(fx)
        return O.with_(
            O.pts_cte(fx),
            "small AS (SELECT * FROM pts WHERE split = 'train' ORDER BY point_id LIMIT 10)",
            O.zp_cte(k, False, src="small"), O.mom_cte(O.z_names(k, False), False),
            O.gd_ctes(k, 5, _alpha(fx), eta), "fw AS (SELECT w FROM gd WHERE i = 5)") + _WEIGHTS_SELECT
    raise ValueError(what)


def _gd_query(fx: str, eta: float, what: str) -> QueryFn:
    def run(spark, sf_dir):
        p = _pipe(spark, sf_dir, fx)
        name = "LR0" if eta == 0 else "RegularizedLR"
        if what == "small":
            return reports.gd_small(p, k=_small_width(fx), eta=eta, alpha=_alpha(fx))
        model, trace = p.gd(GD_ITERATIONS, _alpha(fx), eta, name=name)
        if what == "weights":
            return model.weights_frame(spark).select("feature", r6("weight").alias("weight"))
        if what == "trace":
            return reports.trace_table(spark, trace)
        if what == "val":
            sc = p.score({"Baseline": p.baseline(), name: model}, ["validation"])
            return sc.select("model", r6("rmse").alias("rmse"))
        raise ValueError(what)
    return run


for _fx, _sfx in (("signal", ""), ("embed", "_embed"), ("embed64", "_embed64")):
    for _eta, _tag in ((0.0, "gd"), (GD_L2_ETA, "gd_l2")):
        for _what in ("weights", "trace", "val", "small"):
            if _what == "small" and _fx == "signal":
                continue
            _name = f"{_tag}_{'val_rmse' if _what == 'val' else _what}{_sfx}"
            if _what == "small" and _fx == "embed":
                _name = f"{_tag}_small"
            register(_name, _gd_sql(_fx, _eta, _what))(_gd_query(_fx, _eta, _what))


# the same descents by the per-iteration row path
for _eta, _tag in ((0.0, "gd"), (GD_L2_ETA, "gd_l2")):
    def _rowwise(spark, sf_dir, eta=_eta):
        from linfold.operators.models import LinearModel
        from linfold.operators.rowwise import gd_rowwise
        w, _ = gd_rowwise(_pipe(spark, sf_dir).split("train"), 3, GD_ITERATIONS, 1.0, eta)
        return LinearModel("rows", w, 0.0, 3).weights_frame(spark).select("feature", r6("weight").alias("weight"))
    register(f"{_tag}_weights_rowwise", _gd_sql("signal", _eta, "weights"))(_rowwise)


@register("labeled_prediction", _gd_ctes("signal", 0.0) + (
    f"SELECT point_id, {O.r6('label')} AS label,"
    f" {O.r6(O.predict_expr('fw.w', O.z_names(3, False), False))} AS prediction"
    " FROM zp CROSS JOIN fw WHERE split = 'validation'"))
def q_labeled_prediction(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    model, _ = p.gd(GD_ITERATIONS)
    return p.split("validation").select("point_id", r6("label").alias("label"),
                                        r6(model.prediction()).alias("prediction"))


@register("label_hist_both", O.with_(O.pts_cte("signal")) + (
    "SELECT 'original' AS kind, label_raw AS label, count(*) AS n FROM pts GROUP BY label_raw"
    " UNION ALL SELECT 'shifted' AS kind, label, count(*) AS n FROM pts GROUP BY label"))
def q_label_hist_both(spark, sf_dir):
    return reports.label_histograms(signal_points(spark, sf_dir))


def _tail_sql(eta: float) -> str:
    return _gd_ctes("signal", eta) + (
        f"SELECT CAST(i AS BIGINT) AS iteration, {O.r6('rmse')} AS rmse,"
        f" {O.r6('(rmse - min(rmse) OVER ()) / (max(rmse) OVER () - min(rmse) OVER ())')}"
        f" AS scaled_rmse FROM gd WHERE i >= 6 AND i < {GD_ITERATIONS}")


def _tail_query(eta: float) -> QueryFn:
    def run(spark, sf_dir):
        _, trace = _pipe(spark, sf_dir).gd(GD_ITERATIONS, 1.0, eta)
        return reports.trace_tail(spark, trace, 6)
    return run


register("gd_trace_tail", _tail_sql(0.0))(_tail_query(0.0))
register("gd_l2_trace_tail", _tail_sql(GD_L2_ETA))(_tail_query(GD_L2_ETA))


# ---------------------------------------------------------------- SGD family, search, report
for _name, (_fn, _sql) in search.queries(r6).items():
    register(_name, _sql)(_fn)
for _name, (_fn, _sql) in reports.queries(r6).items():
    register(_name, _sql)(_fn)
