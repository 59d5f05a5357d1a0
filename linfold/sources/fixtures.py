"""Point tables derived from the test tables (see FIXTURES.md).

``embed_points``  -- 12 min-max-scaled embedding dimensions, label 1990..1999.
``signal_points`` -- 3 lineitem features with a label that depends on them.
``embed_points_full`` -- the same with all 64 dimensions.
``embed_text_points`` -- ``embed_points_full`` written as text and parsed back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.vectors import sql_double
from linfold.operators.aggregates import tree_agg
from linfold.session import at_exit_remove, scratch_path
from linfold.sources.text import parse_points, points_to_lines, read_lines, write_lines

TEXT_MIN_PARTITIONS = 2

# Fixed values of the derived fixtures.
EMBED_WIDTH = 12
EMBED_FULL_WIDTH = 64
EMBED_LABEL_BASE = 1990
SIGNAL_LABEL_EXPR = ("1922 + floor(40*(l_quantity/50) + 30*(l_discount*10)*(l_quantity/50)"
                     " + 10*(l_tax*10))")


def _table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_table_path(sf_dir, name))


def embed_points(spark: SparkSession, sf_dir: str, d: int = EMBED_WIDTH) -> DataFrame:
    """``(point_id BIGINT, label DOUBLE, features ARRAY<DOUBLE>)`` from embeddings.

    Each of the first ``d`` dimensions is min-max scaled over the whole table.
    The 2d range ends come from one small aggregate job (2d numbers whatever
    the table size) and enter the row plan as literals.
    """
    emb = _table(spark, sf_dir, "embeddings")
    raw = emb.select(
        F.col("vec_id").alias("point_id"),
        (F.lit(EMBED_LABEL_BASE) + F.col("label")).cast("double").alias("label"),
        *[F.col("embedding").getItem(k).cast("double").alias(f"_e{k}") for k in range(d)],
    )
    rng = tree_agg(raw, [], [(f"{name}{k}", kind, f"_e{k}") for k in range(d)
                             for name, kind in (("lo", "min"), ("hi", "max"))]).collect()[0]
    parts = []
    for k in range(d):
        lo, hi = rng[f"lo{k}"], rng[f"hi{k}"]
        if lo is None or hi is None or hi == lo:
            parts.append("(0.0D)")
        else:
            parts.append(f"((_e{k} - {sql_double(lo)}) / ({sql_double(hi)} - {sql_double(lo)}))")
    return raw.select("point_id", "label", F.expr(f"array({', '.join(parts)})").alias("features"))


def signal_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(point_id STRING, label DOUBLE, features ARRAY<DOUBLE>)`` from lineitem.

    Only five lineitem columns are read (column pruning reaches the scan).
    ``point_id`` = ``l_orderkey|l_linenumber`` and is not unique.
    """
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("|", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("point_id"),
        F.expr(SIGNAL_LABEL_EXPR).cast("double").alias("label"),
        F.array((F.col("l_quantity") / 50), (F.col("l_discount") * 10),
                (F.col("l_tax") * 10)).alias("features"),
    )


def embed_points_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embed_points`` with every stored dimension."""
    return embed_points(spark, sf_dir, EMBED_FULL_WIDTH)


def embed_text_points(spark: SparkSession, sf_dir: str, mode: str = "strict",
                      path: str | None = None) -> DataFrame:
    """embed points of full width written as text lines, then scanned and parsed.

    Each call writes a folder of its own under the shared folder (removed when
    the driver ends), or the given ``path``: what is parsed is never older than
    its source.
    """
    if path is None:
        path = scratch_path(spark, "points-text")
        at_exit_remove(spark, path)
    write_lines(points_to_lines(embed_points_full(spark, sf_dir), EMBED_FULL_WIDTH), path)
    lines = read_lines(spark, path, min_partitions=TEXT_MIN_PARTITIONS)
    return parse_points(lines, mode=mode, expected_width=EMBED_FULL_WIDTH)


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of points among lines that are none: the signal points' text and
    the documents' texts."""
    texts = _table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return points_to_lines(signal_points(spark, sf_dir), 3).unionByName(texts)
