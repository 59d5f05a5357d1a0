"""Grouped aggregation with a two-level tree for hot keys.

The pipeline groups by very few keys (a split column where one key holds
80% of the rows, or no key at all). A plain ``groupBy`` already combines
map-side, but every map task still sends one partial row per key to a
single reducer per key. ``tree_agg`` first groups by (keys, partition
bucket) -- one partial row per key and task, spread over ``fanout``
reducers -- and then merges those few rows per key. Row counts per group
are never collected anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVEL1 = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_LEVEL2 = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
_LEVEL2_SQL = {"sum": "sum", "min": "min", "max": "max", "count": "sum"}


def _level1(name: str, kind: str, expr) -> Column:
    if isinstance(expr, str):  # SQL text: one JVM call per aggregate
        return F.expr(f"{kind}({expr}) AS `{name}`")
    return _LEVEL1[kind](expr).alias(name)


def _level2(name: str, kind: str) -> Column:
    return F.expr(f"{_LEVEL2_SQL[kind]}(`{name}`) AS `{name}`")


def default_fanout(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def tree_agg(df: DataFrame, keys: Sequence[str], specs: Sequence[tuple[str, str, Column | str]],
             fanout: int | None = None) -> DataFrame:
    """Aggregate ``specs`` = [(name, 'sum'|'min'|'max'|'count', expr)] per ``keys``;
    ``expr`` is a Column or SQL text.

    ``fanout`` <= 1 gives a single-level aggregate.
    """
    fanout = default_fanout(df) if fanout is None else fanout
    keys = list(keys)
    if fanout <= 1:
        aggs = [_level1(n, k, e) for n, k, e in specs]
        return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    bucket = (F.spark_partition_id() % F.lit(fanout)).alias("_bucket")
    lvl1 = df.groupBy(*keys, bucket).agg(*[_level1(n, k, e) for n, k, e in specs])
    aggs2 = [_level2(n, k) for n, k, _ in specs]
    if keys:
        return lvl1.groupBy(*keys).agg(*aggs2)
    return lvl1.agg(*aggs2)


FAN_IN = 256  # map tasks whose vectors one first-level group sums


def vector_sum(partials: DataFrame, key: str) -> DataFrame:
    """Element-wise sums of ``(key, part, vec ARRAY<DOUBLE>)`` per key.

    ``part`` is the map task; its vectors are summed for ``FAN_IN`` tasks at a
    time and then per key, so a key's task reads tasks / FAN_IN rows. One fixed
    plan, whatever the source. NaN and infinity pass through."""
    def total(table):
        import pyarrow as pa
        vecs = table.column("vec").combine_chunks()
        acc = vecs.flatten().to_numpy(zero_copy_only=False).reshape(len(vecs), -1).sum(axis=0)
        return pa.table({key: table.column(key).slice(0, 1),
                         "vec": pa.array([acc], pa.list_(pa.float64()))})

    schema = f"`{key}` string, vec array<double>"
    level1 = partials.withColumn("_group", F.floor(F.col("part") / FAN_IN)) \
        .groupBy(key, "_group").applyInArrow(total, schema)
    return level1.groupBy(key).applyInArrow(total, schema)


def checked_arrays(batch, d: int):
    """(labels, features as an n x d matrix) of the columns ``label`` and
    ``features`` of an Arrow batch; bad points fail, as in ``checked_points``."""
    label, feats = batch.column("label"), batch.column("features")
    flat = feats.flatten()
    widths = np.diff(feats.offsets.to_numpy())
    if label.null_count or feats.null_count or flat.null_count or (widths != d).any():
        raise ValueError(f"bad point: a null, or a width other than {d}")
    return (label.to_numpy(zero_copy_only=False).astype(np.float64),
            flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d))


def checked_points(points: DataFrame, d: int) -> DataFrame:
    """``points`` whose bad rows fail the job: a null label, null features or a
    null among them, or a width other than ``d``. The check is part of the
    column, so it costs no pass and runs wherever features are read."""
    f, n = "`features`", int(d)
    nulls = " OR ".join(f"{f}[{k}] IS NULL" for k in range(n)) if n <= 64 else f"exists({f}, x -> x IS NULL)"
    bad = f"`label` IS NULL OR {f} IS NULL OR size({f}) <> {n}" + (f" OR {nulls}" if nulls else "")
    message = f"'bad point: a null, or a width other than {n}'"
    good = F.expr(f"CASE WHEN {bad} THEN raise_error({message}) ELSE {f} END").cast("array<double>")
    return points.withColumn("features", good)
