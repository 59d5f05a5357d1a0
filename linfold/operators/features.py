"""Feature and label transforms on point frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.vectors import two_way_interactions
from linfold.operators.aggregates import tree_agg


def label_range(points: DataFrame, label: str = "label") -> DataFrame:
    """One pass for both ends of the label range."""
    return tree_agg(points, [], [("min_label", "min", F.col(label)), ("max_label", "max", F.col(label))])


def shift_labels(points: DataFrame, label: str = "label", keep_raw: bool = False) -> DataFrame:
    """Subtract the global minimum label so the smallest label is 0.

    The minimum is a scalar subquery: computed once by its own small job and
    substituted as a constant, so the row plan stays one code-generated stage.
    """
    lo = tree_agg(points, [], [("lo", "min", F.col(label))]).scalar()
    cols = [c for c in points.columns if c != label]
    extra = [F.col(label).alias("label_raw")] if keep_raw else []
    return points.select(*cols, (F.col(label) - lo).alias(label), *extra)


def slice_features(points: DataFrame, k: int, features: str = "features") -> DataFrame:
    """Keep the first ``k`` features."""
    return points.withColumn(features, F.slice(features, 1, k))


def add_interactions(points: DataFrame, d: int | None = None,
                     features: str = "features") -> DataFrame:
    """Append the row-major two-way products (width d -> d + d^2)."""
    return points.withColumn(features, two_way_interactions(features, d))


def explode_features(points: DataFrame, keys=("point_id",), features: str = "features") -> DataFrame:
    """Long form ``(keys..., feature INT, value DOUBLE)``."""
    return points.select(*keys, F.posexplode(features).alias("feature", "value"))


def min_max_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """Linear map of ``col`` to [0, 1] with whole-frame min and max (0 when flat).

    Both ends come from one struct-valued scalar subquery (one aggregate
    job); the row plan then reads them as constants."""
    ends = tree_agg(df, [], [("lo", "min", F.col(col)), ("hi", "max", F.col(col))]) \
        .select(F.struct("lo", "hi")).scalar()
    lo, width = ends.getField("lo"), ends.getField("hi") - ends.getField("lo")
    scaled = F.when(width == 0, F.lit(0.0)).otherwise((F.col(col) - lo) / width)
    return df.withColumn(out, scaled)
