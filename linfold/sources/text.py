"""Delimited text points: ``label,f1,f2,...`` one point per line.

``read_lines`` is the scan (S1), ``parse_points`` the parse (P1) in a
strict mode (a bad line fails the job, as a plain double coercion would)
and a permissive mode (bad tokens become nulls and the row is flagged),
``feature_width`` the width check (P2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linfold.operators.aggregates import tree_agg


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Scan text lines as ``value STRING``.

    ``min_partitions`` is a least number of splits, as a text reader's minimum
    split count: an input that has as many by itself is read as it is. A smaller
    one is read in smaller splits, by a reader session whose split size follows
    the minimum and whose other settings are those of ``spark`` now; nothing is
    shuffled either way. A file that cannot be split (gzip) stays one split."""
    df = spark.read.text(path)
    if not min_partitions or df.rdd.getNumPartitions() >= min_partitions:
        return df
    reader = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if reader.conf.isModifiable(k):
            reader.conf.set(k, v)
    reader.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    reader.conf.set("spark.sql.files.openCostInBytes", "1")  # the least size of a split
    return reader.read.text(path)


def _tokens(value: Column, sep: str) -> Column:
    return F.split(value, sep)


def parse_points(lines: DataFrame, mode: str = "strict", value_col: str = "value",
                 sep: str = ",", expected_width: int | None = None,
                 id_col: str | None = None) -> DataFrame:
    """Parse lines into ``(point_id, label, features)``.

    * label = first token as double, features = the remaining tokens as doubles;
    * ``point_id`` is ``id_col`` when given, else the first 16 hex digits of
      the line's md5 (stable across partitioning; equal lines share an id);
    * ``mode='strict'`` raises on the first bad line (non-numeric token,
      empty line, or a width different from ``expected_width``);
      ``mode='permissive'`` keeps every line and adds ``parse_ok``.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    value = F.col(value_col)
    toks = _tokens(value, sep)
    label = F.get(toks, F.lit(0)).try_cast("double")
    feats = F.transform(F.slice(toks, 2, F.size(toks) - 1), lambda t: t.try_cast("double"))
    bad = label.isNull() | F.exists(feats, lambda x: x.isNull())
    if expected_width is not None:
        bad = bad | (F.size(feats) != F.lit(expected_width))
    pid = F.col(id_col) if id_col else F.substring(F.md5(value), 1, 16)
    base = lines.select(pid.alias("point_id"), value.alias("_line"),
                        label.alias("label"), feats.alias("features"), bad.alias("_bad"))
    if mode == "strict":
        checked = F.when(F.col("_bad"), F.raise_error(
            F.concat(F.lit("unparseable point: "), F.coalesce(F.col("_line"), F.lit("<null>")))
        )).otherwise(F.col("label"))
        return base.select("point_id", checked.cast("double").alias("label"), "features")
    return base.select("point_id", "label", "features", (~F.col("_bad")).alias("parse_ok"))


def observed_points(lines: DataFrame, expected_width: int, **options) -> tuple[DataFrame, Observation]:
    """The good points of a permissive parse, and what the pass that reads them
    counts on its way: ``n_lines`` and ``n_bad``, to be had by ``get`` once the first
    action on the points is over. No pass of its own."""
    seen = Observation()
    parsed = parse_points(lines, mode="permissive", expected_width=expected_width, **options)
    counted = parsed.observe(seen, F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("parse_ok")).alias("n_bad"))
    return counted.where("parse_ok").drop("parse_ok"), seen


def parse_report(parsed: DataFrame) -> DataFrame:
    """One-row summary of a permissive parse: lines, good, bad, width range."""
    ok = F.col("parse_ok")
    width = F.when(ok, F.size("features"))
    return tree_agg(parsed, [], [
        ("n_lines", "count", F.lit(1)), ("n_parsed", "count", F.when(ok, 1)),
        ("n_bad", "count", F.when(~ok, 1)), ("min_width", "min", width), ("max_width", "max", width)])


def feature_width(points: DataFrame, features: str = "features") -> DataFrame:
    """Width check: ``(n, min_width, max_width, consistent)`` in one pass."""
    w = F.size(features)
    return tree_agg(points, [], [("n", "count", F.lit(1)), ("min_width", "min", w),
                                 ("max_width", "max", w)]) \
        .withColumn("consistent", F.col("min_width") == F.col("max_width"))


def points_to_lines(points: DataFrame, d: int) -> DataFrame:
    """``label,f1,...,fd`` text; doubles print in round-trip form."""
    cols = [F.col("label").cast("string")] + [F.col("features").getItem(k).cast("string")
                                               for k in range(d)]
    return points.select(F.concat_ws(",", *cols).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").text(path)
