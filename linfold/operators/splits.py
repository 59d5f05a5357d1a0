"""Train / validation / test assignment.

The default is a hash split: bucket = first 8 hex digits of
``md5('<seed>|<id>')`` mod 1000, compared with cumulative weights. It needs
no shuffle, does not depend on partitioning, survives recomputation after
executor loss, and any SQL engine with md5 reproduces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.operators.aggregates import tree_agg

SPLIT_NAMES = ("train", "validation", "test")
SPLIT_WEIGHTS = (0.8, 0.1, 0.1)
SPLIT_SEED = 42
BUCKETS = 1000


def split_bucket(id_col: Column | str, seed: int = SPLIT_SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(BUCKETS))


def _thresholds(weights: Sequence[float]) -> list[int]:
    total = float(sum(weights))
    shares = [w / total * BUCKETS for w in weights]
    if any(w < 0 or abs(x - round(x)) > 1e-6 for w, x in zip(weights, shares)):
        raise ValueError(f"weights must be multiples of 1/{BUCKETS} of their sum: {list(weights)}")
    return [int(round(sum(shares[:k + 1]))) for k in range(len(shares) - 1)]


def hash_split(points: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
               seed: int = SPLIT_SEED, names: Sequence[str] = SPLIT_NAMES,
               id_col: str = "point_id") -> DataFrame:
    """Add a ``split`` column (disjoint, reproducible)."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    th = _thresholds(weights)
    b = F.col("_bucket")
    expr = F.lit(names[-1])
    for t, name in reversed(list(zip(th, names[:-1]))):
        expr = F.when(b < F.lit(t), F.lit(name)).otherwise(expr)
    # the bucket is its own projection so the md5 runs once per row
    return points.withColumn("_bucket", split_bucket(id_col, seed)) \
        .withColumn("split", expr).drop("_bucket")


def one_split(points: DataFrame, name: str, weights: Sequence[float] = SPLIT_WEIGHTS,
              seed: int = SPLIT_SEED, names: Sequence[str] = SPLIT_NAMES,
              id_col: str = "point_id") -> DataFrame:
    """The rows of one split of ``hash_split``: one range test on the bucket."""
    edges = [0, *_thresholds(weights), BUCKETS]
    k = list(names).index(name)
    # the number of a range's only cell: one evaluation of the hash, unlike two comparisons
    inside = F.width_bucket(split_bucket(id_col, seed).cast("double"), F.lit(float(edges[k])),
                            F.lit(float(edges[k + 1])), F.lit(1)) == 1
    return points.where(inside).withColumn("split", F.lit(name))


def random_split(points: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
                 seed: int = SPLIT_SEED, names: Sequence[str] = SPLIT_NAMES) -> DataFrame:
    """Bernoulli split: one uniform number per row against cumulative weights.

    One pass, no sort. Sizes are approximate and membership depends on
    partitioning; use ``hash_split`` when results are compared.
    """
    if len(weights) != len(names) or min(weights) < 0:
        raise ValueError("one name and one weight of at least 0 each")
    total, acc = float(sum(weights)), 0.0
    u, expr = F.col("_u"), None
    for w, name in zip(weights[:-1], names[:-1]):
        acc += w / total
        expr = (F.when(u < acc, F.lit(name)) if expr is None else expr.when(u < acc, F.lit(name)))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return points.withColumn("_u", F.rand(seed)).withColumn("split", expr).drop("_u")


def split_sizes(points: DataFrame, split: str = "split", fanout: int | None = None) -> DataFrame:
    """``(split, n, total, sizes_add_up)``: per-split counts beside an
    independent count of all points, and whether the split sizes add up.

    Two passes by design (the check compares two computations); the sum of
    the split sizes is a window over the few per-split rows, not a rescan."""
    from pyspark.sql import Window
    per = tree_agg(points, [split], [("n", "count", F.lit(1))], fanout)
    total = tree_agg(points, [], [("total", "count", F.lit(1))], fanout).scalar()
    split_total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return per.select(split, "n", total.alias("total"),
                      (split_total == total).alias("sizes_add_up"))
