"""Deterministic first-k rows (the ordered counterpart of ``take``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_k(points: DataFrame, k: int, order=("point_id", "label", "features")) -> DataFrame:
    """The first ``k`` points by id; ties (non-unique ids) are broken by the
    label and then the feature array (lexicographic), so the result does not
    depend on partitioning. Plans as a distributed top-k
    (``TakeOrderedAndProject``): each task keeps k rows, never the whole input."""
    cols = [c for c in order if c in points.columns]
    return points.orderBy(*cols).limit(k)
