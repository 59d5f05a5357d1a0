"""Quality rules: base rules, then robust multivariate outliers.

Each document's statistics are counted by column expressions on its own row.
The documents that pass the base rules are grouped by language and source, by
language, and all together; for each of these groups the minimum covariance
determinant is estimated by concentration steps: keep the rows whose
Mahalanobis distance is at most the group's ``SUBSET`` quantile, take their mean
and covariance, and repeat until no group's log-determinant falls by more than
``SETTLED`` (``STEPS`` times at most). There are two starts, median and median
absolute deviation per dimension, and mean and covariance of all rows; the one
that ends with the smaller determinant counts. Its covariance is scaled so that
the group's median distance is that of the normal distribution.

Small groups borrow: mean and covariance of a language are averaged with those
of all documents, weighted by its n and ``BORROWED``, and those of a language
and source with these, in the same way; the covariance of all documents takes
in ``ASSUMED`` documents of unit covariance. So there is no size below which a
group has no estimate of its own, and in a handful of documents nothing is an
outlier. A document is rejected when its squared distance from the estimate of
its language and source is over ``CUTOFF``.

Every step is two aggregates per group and joins of the groups' parameters to
slim rows (a few doubles per document, staged once): no row is collected. The
parameters are broadcast where a count shows at most ``GROUPS`` of them, and
else meet the rows by group and salt, so that a group that holds a third of all
rows is combined inside many tasks before it is shuffled. The 5 x 5 Cholesky
factor and the distance are column expressions.

Only DataFrame functions. Defined results: a null text has no words and fails
the base rules; null languages and sources are groups of their own. A dimension
without variance gets the floor ``RIDGE`` on its variance. Repeated rows are
judged each, alike; ``d2`` is null for documents that fail the base rules. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.llm.common import SPACE, staged, unstage

SUBSET = 0.6  # share of each group that a concentration step keeps: two in five may be outliers
STEPS = 8
SETTLED = 0.001
BORROWED = 100  # documents that a group's parent counts for
ASSUMED = 10  # documents of unit covariance among all
RIDGE = 0.01  # added to each variance, in units of the transformed statistics
GROUPS = 50_000  # groups whose parameters are broadcast, some 400 bytes each
SALTS = 32
#: Squared distance (5 dimensions) beyond which a document is an outlier: text
#: statistics have far heavier tails than the normal distribution (many clean
#: documents repeat no line and no phrase, some repeat a few), so the bound is
#: well beyond its quantiles (20.5 at 0.999, 35.9 at 0.999999).
CUTOFF = 400.0
#: Median of the chi-squared distribution with 5 degrees of freedom.
CHI2_MEDIAN = 4.351
DIMS = ("x0", "x1", "x2", "x3", "x4")
CELLS = [(i, j) for i in range(5) for j in range(i + 1)]
PARAMETERS = [f"m{i}" for i in range(5)] + [f"c{i}{j}" for i, j in CELLS]


def text_stats(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, lang, source, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, and the row itself in ``row``)."""
    rows = docs.select("doc_id", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return _measured(rows).drop("text")


def _measured(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``, not null) and the statistics."""
    has_word = r"[^\x20\x09-\x0D]"
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(has_word))
    squeezed = F.regexp_replace("text", SPACE, " ")
    symbols = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    rows = rows.withColumns({
        "_words": F.filter(F.split(squeezed, " ", -1), lambda x: x != ""),
        "_lines": lines, "n_symbols": symbols.cast("long")})
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # 3-word windows as (digest, place), in order of digest
        "_grams": F.expr("""sort_array(transform(slice(_words, 1, greatest(size(_words) - 2, 0)),
            (w, i) -> struct(xxhash64(w, get(_words, i + 1), get(_words, i + 2)) as h, i as p)))""")})
    # windows whose digest a neighbour shares, by place; each covers up to the next one's start
    again = F.expr("""transform(filter(_grams, (g, j) -> g.h <=> get(_grams, j - 1).h or g.h <=> get(_grams, j + 1).h), g -> g.p)""")
    rows = rows.withColumn("_again", F.sort_array(again))
    covered = F.expr("""case when size(_again) = 0 then 0 else 3 + aggregate(
        transform(_again, (p, j) -> least(3, coalesce(get(_again, j + 1) - p, 0))), 0, (n, d) -> n + d) end""")
    rows = rows.withColumn("n_repeat_words", covered.cast("long"))
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
                           ).drop("_words", "_lines", "_grams", "_again")


def _transformed() -> list[Column]:
    """The statistic vector on scales on which groups are roughly normal."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n) * 4,
            F.sqrt(F.col("n_symbols") / n) * 4, F.sqrt(F.col("n_dup_lines") / n) * 2,
            F.sqrt(F.col("n_repeat_words") / n)]


def _estimate(rows: DataFrame, by: list[str], where: Column) -> DataFrame:
    """(by, n, m0 to m4, lower cells of the covariance) of each group: its size,
    and mean and covariance over its rows ``where``."""
    kept = lambda c: F.when(where, F.col(c))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(kept(d)).alias(f"m{i}") for i, d in enumerate(DIMS)],
        *[(F.covar_pop(kept(DIMS[i]), kept(DIMS[j])) + (RIDGE if i == j else 0.0)).alias(f"c{i}{j}") for i, j in CELLS])


def _whitened(stats: DataFrame, by: list[str]) -> DataFrame:
    """``stats`` (of ``_estimate``) with ``fit``, the mean and the whitening matrix
    (the inverse Cholesky factor of the covariance), and ``logdet``."""
    out = stats
    for i, j in CELLS:  # row by row of the factor, then its inverse; one row per group
        v = F.col(f"c{i}{j}")
        for k in range(j):
            v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(1e-9))) if i == j else v / F.col(f"l{j}{j}"))
    for j in range(5):
        for i in range(j, 5):
            v = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                v = v - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            out = out.withColumn(f"w{i}{j}", v / F.col(f"l{i}{i}"))
    fit = [f"m{i}" for i in range(5)] + [f"w{i}{j}" for i, j in CELLS]
    logdet = sum((2 * F.log(f"l{i}{i}") for i in range(1, 5)), 2 * F.log("l00"))
    return out.select(*by, "n", *PARAMETERS, F.struct(*fit).alias("fit"), logdet.alias("logdet"))


def _distance() -> Column:
    """Squared Mahalanobis distance: the length of the whitened difference."""
    off = [F.col(d) - F.col(f"fit.m{i}") for i, d in enumerate(DIMS)]
    rows = [sum((F.col(f"fit.w{i}{j}") * off[j] for j in range(1, i + 1)), F.col(f"fit.w{i}0") * off[0]) for i in range(5)]
    return sum((v * v for v in rows[1:]), rows[0] * rows[0])


def _joined(rows: DataFrame, params: DataFrame, by: list[str], small: bool, how: str = "inner") -> DataFrame:
    """Rows with their group's parameters; ``by`` columns hold no nulls."""
    if small:
        return rows.join(F.broadcast(params), by, how)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*DIMS), F.lit(SALTS)).cast("int"))
    params = params.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(params, [*by, "_salt"], how).drop("_salt")


def fit_groups(points: DataFrame, by: list[str], small: bool, steps: int = STEPS, subset: float = SUBSET) -> DataFrame:
    """(by, n, v): size and minimum covariance determinant estimate of each
    group of ``points`` (by, x0 to x4): its ``PARAMETERS`` as an array, the
    covariance scaled by the median distance. ``small``: the groups'
    parameters are few enough to be broadcast."""
    each = [*by, "start"]
    middle = lambda c: F.percentile_approx(c, 0.5, 1000)
    mid = staged(points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[middle(d).alias(f"m{i}") for i, d in enumerate(DIMS)]), "mcd")
    mad = _joined(points, mid, by, small).groupBy(*by).agg(
        F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(5)],
        *[middle(F.abs(F.col(d) - F.col(f"m{i}"))).alias(f"s{i}") for i, d in enumerate(DIMS)])
    robust = mad.select(*by, F.lit(0).alias("start"), "n", *[f"m{i}" for i in range(5)], *[
        ((1.4826 * F.col(f"s{i}")) ** 2 + RIDGE if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in CELLS])
    plain = _estimate(points.withColumn("start", F.lit(1)), each, F.lit(True))
    fit = staged(_whitened(robust.unionByName(plain), each), "mcd")
    unstage(mid)
    for _ in range(steps):
        near = _joined(points, fit.select(*each, "fit"), by, small).withColumn("d2", _distance()).drop("fit")
        cut = staged(near.groupBy(*each).agg(F.percentile_approx("d2", subset, 1000).alias("cut")), "mcd")
        near = _joined(points, fit.select(*each, "fit").join(cut, each), by, small).withColumn("d2", _distance())
        after = staged(_whitened(_estimate(near, each, F.col("d2") <= F.col("cut")), each), "mcd")
        fell = fit.select(*each, F.col("logdet").alias("before")).join(after, each).agg(F.max(F.abs(F.col("before") - F.col("logdet")))).first()[0]
        unstage(fit, cut)
        fit = after
        if fell is None or fell <= SETTLED:
            break
    best = fit.groupBy(*by).agg(F.min_by(F.struct("n", "fit", *PARAMETERS), F.struct("logdet", "start")).alias("b")).select(*by, "b.*")
    half = _joined(points, best.select(*by, "fit"), by, small).groupBy(*by).agg(
        F.percentile_approx(_distance(), 0.5, 1000).alias("cut"))
    scale = F.when(F.col("cut") > 0, F.col("cut") / CHI2_MEDIAN).otherwise(1.0)
    out = staged(best.join(half, by).select(*by, "n", F.array(
        *[F.col(c) if c[0] == "m" else F.col(c) * scale for c in PARAMETERS]).alias("v")), "mcd")
    unstage(fit)
    return out


def shrunk_groups(fits: DataFrame) -> DataFrame:
    """(g_lang, g_source, fit) of each language and source, from the ``fits`` of
    these, of languages (source ``*``) and of all documents (both ``*``)."""
    whole = fits.where("g_lang = '*'").select("n", "v").first()  # one row of 21 numbers
    if whole is None:
        whole = {"n": 0, "v": [0.0] * len(PARAMETERS)}
    unit = [None if c[0] == "m" else float(c[1] == c[2]) for c in PARAMETERS]
    every = F.array(*[F.lit(float(v) if u is None else (whole["n"] * v + ASSUMED * u) / (whole["n"] + ASSUMED))
                      for v, u in zip(whole["v"], unit, strict=True)])
    borrow = lambda n, v, parent: F.zip_with(v, parent, lambda x, y: (F.col(n) * x + BORROWED * y) / (F.col(n) + BORROWED))
    langs = fits.where("g_lang <> '*' and g_source = '*'").select("g_lang", borrow("n", F.col("v"), every).alias("parent"))
    groups = fits.where("g_source <> '*'").join(langs, "g_lang")
    v = groups.select("g_lang", "g_source", "n", borrow("n", F.col("v"), F.col("parent")).alias("v"))
    cells = v.select("g_lang", "g_source", "n", *[F.col("v")[k].alias(c) for k, c in enumerate(PARAMETERS)])
    return staged(_whitened(cells, ["g_lang", "g_source"]).select("g_lang", "g_source", "fit"), "mcd")


def judge_stats(stats: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with ``d2`` (null where the base rules failed) and ``kept``.
    ``stats`` must be a stored table: each concentration step reads it."""
    by = ["g_lang", "g_source"]
    # null, empty and other values stay apart, and from the groups named *
    tag = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))
    points = stats.withColumns({"g_lang": tag("lang"), "g_source": tag("source"),
                                **{d: x for d, x in zip(DIMS, _transformed(), strict=True)}})
    good = points.where(~F.col("base_failed")).select(*by, *DIMS)
    # each row also counts for the estimates of its language and of all documents
    star = F.lit("*")
    levels = good.select(F.explode(F.array(*[F.struct(x.alias("g_lang"), y.alias("g_source")) for x, y in (
        (F.col("g_lang"), F.col("g_source")), (F.col("g_lang"), star), (star, star))])).alias("g"), *DIMS).select("g.*", *DIMS)
    small = levels.select(*by).distinct().count() <= GROUPS
    fits = shrunk_groups(fit_groups(levels, by, small))
    out = _joined(points, fits, by, small, "left")
    out = out.withColumn("d2", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("d2") > cutoff, F.lit(False))
    return out.withColumn("kept", kept).drop("fit", *by, *DIMS)


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, d2) of every row."""
    slim = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    stats = staged(_measured(slim).drop("text"), "stats")
    return judge_stats(stats, cutoff).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def quality_filter(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs``, all columns as they came, that ``quality_rules`` keeps."""
    stats = staged(text_stats(docs), "stats")
    return judge_stats(stats, cutoff).where("kept").select("row.*")
