"""Moments of wide models as tiles of one outer-product matrix.

With a row ``z = [features or features and products, 1, label]`` the matrix
``sum z z'`` per group holds every moment: the Gram matrix, the feature sums, the
label products and sums, the row count. It is cut into square tiles of ``TILE``;
a map task forms only the columns of a tile and adds up the tiles of its pass, at
most ``HELD`` numbers, one row ``(group, i, j, tile)`` each. More tiles than that
take further passes over the rows. Rows are summed by tile, spread over the
reducers: ``FAN_IN`` tasks at a time, in three levels, so no task holds more than
``FAN_IN`` tiles at once below 16 million map tasks. The driver gets one matrix per
group in the end, if a training asks for it.

The minimum of another column can ride along with the last tile.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.operators.aggregates import checked_arrays, checked_points
from linfold.operators.moments import Moments

TILE = 128  # 131 KB a tile
HELD = 8_000_000  # numbers that a task adds up in one pass: 64 MB
FAN_IN = 256
LEVELS = 3

_SCHEMA = "{by} string, i int, j int, part long, vec array<double>, lo double"


def columns_of(x: np.ndarray, y: np.ndarray, first: int, last: int, interactions: bool) -> np.ndarray:
    """Columns ``first`` to ``last`` (exclusive) of z for a batch: the features, their
    products in row-major order if ``interactions``, 1, the label."""
    n, d = x.shape
    width = d + d * d if interactions else d
    parts = [x[:, first:min(last, d)]] if first < d else []
    k = np.arange(max(first, d), min(last, width))
    if interactions and len(k):
        i, j = np.divmod(k - d, d)
        parts.append(x[:, i] * x[:, j])
    if first <= width < last:
        parts.append(np.ones((n, 1)))
    if first <= width + 1 < last:
        parts.append(y[:, None])
    return np.hstack(parts)


def tile_passes(width: int, tile: int = TILE, held: int = HELD) -> list[list[tuple[int, int]]]:
    """The tiles (i, j), i <= j, of z of a model of this width, by pass."""
    side = -(-(width + 2) // tile)
    pairs = [(i, j) for i in range(side) for j in range(i, side)]
    step = max(1, held // (tile * tile))
    return [pairs[k:k + step] for k in range(0, len(pairs), step)]


def _total(by: str, group: str | None):
    def total(table):
        import pyarrow as pa
        import pyarrow.compute as pc
        vec = table.column("vec").combine_chunks()
        total = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1).sum(axis=0)
        first = table.slice(0, 1)
        return pa.table({by: first[by], "i": first["i"], "j": first["j"],
                         "part": first[group] if group else pa.array([0], pa.int64()),
                         "vec": pa.array([total], pa.list_(pa.float64())), "lo": pa.array([pc.min(table["lo"]).as_py()], pa.float64())})
    return total


def tiled_moments(points: DataFrame, d: int, by: str = "split", interactions: bool = False, min_of: str | None = None,
                  checked: bool = False, tile: int = TILE, held: int = HELD) -> DataFrame:
    """``(by, i, j, vec, lo)``: the tiles per group, ``lo`` the minimum of ``min_of``
    with the last of them. Bad points fail, as on every path."""
    if not checked:
        points = checked_points(points, d)
    width = d + d * d if interactions else d
    rows = points.select(F.col(by).cast("string").alias(by), F.col("label").cast("double").alias("label"), "features",
                         F.col(min_of).cast("double").alias("_lo") if min_of else F.lit(None).cast("double").alias("_lo"))
    last = (width + 1) // tile

    def partial(pairs):
        blocks = sorted({k for p in pairs for k in p})

        def run(batches):
            import pyarrow as pa
            from pyspark import TaskContext
            acc: dict[str, list[np.ndarray]] = {}
            lows: dict[str, float] = {}
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                keys, (y, x) = rb.column(0).to_numpy(zero_copy_only=False), checked_arrays(rb, d)
                low = rb.column(3).to_numpy(zero_copy_only=False)
                for key in np.unique(keys):
                    sel = keys == key
                    z = {k: columns_of(x[sel], y[sel], k * tile, min((k + 1) * tile, width + 2), interactions) for k in blocks}
                    sums = acc.setdefault(key, [np.zeros((z[i].shape[1], z[j].shape[1])) for i, j in pairs])
                    for s, (i, j) in zip(sums, pairs):
                        s += z[i].T @ z[j]
                    if min_of:
                        lows[key] = min(lows.get(key, np.inf), float(np.nanmin(low[sel].astype(float), initial=np.inf)))
            part = TaskContext.get().partitionId()
            for key, sums in acc.items():
                for s, (i, j) in zip(sums, pairs):
                    lo = lows[key] if min_of and (i, j) == (last, last) else None
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key], pa.string()), pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part], pa.int64()),
                         pa.array([s.ravel()], pa.list_(pa.float64())), pa.array([lo], pa.float64())], names=[by, "i", "j", "part", "vec", "lo"])
        return run

    schema, out = _SCHEMA.format(by=f"`{by}`"), None
    for pairs in tile_passes(width, tile, held):
        tiles = rows.mapInArrow(partial(pairs), schema)
        out = tiles if out is None else out.unionByName(tiles)
    for level in range(LEVELS):
        top = level == LEVELS - 1
        if not top:
            out = out.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
        out = out.groupBy(by, "i", "j", *[] if top else ["part"]).applyInArrow(_total(by, None if top else "part"), schema)
    return out.drop("part")


def collect_tiles(frame: DataFrame, d: int, by: str = "split", interactions: bool = False,
                  tile: int = TILE) -> tuple[dict[str, Moments], float | None]:
    """The moments per group on the driver, and the minimum that rode along. Tiles
    come as vectors, one per group and tile."""
    width = d + d * d if interactions else d
    got = frame.select(by, "i", "j", "vec", "lo").toArrow()
    full: dict[str, np.ndarray] = {}
    for key, i, j, vec in zip(got[by].to_pylist(), got["i"].to_pylist(), got["j"].to_pylist(), got["vec"]):
        z = full.setdefault(key, np.zeros((width + 2, width + 2)))
        a, b = slice(i * tile, (i + 1) * tile), slice(j * tile, (j + 1) * tile)
        z[a, b] = vec.values.to_numpy(zero_copy_only=False).reshape(z[a, b].shape)
        z[b, a] = z[a, b].T
    lows = [v for v in got["lo"].to_pylist() if v is not None and np.isfinite(v)]
    one, y = width, width + 1
    return {key: Moments(int(round(z[one, one])), float(z[one, y]), float(z[y, y]), z[:width, one].copy(), z[:width, y].copy(),
                         z[:width, :width].copy()) for key, z in full.items()}, min(lows) if lows else None


def tile_report(frame: DataFrame, d: int, by: str = "split", interactions: bool = False, tile: int = TILE) -> DataFrame:
    """``(by, feature, row_sum, square_sum, label_sum)`` without bringing the matrix
    to the driver: of each feature its products with all features summed, its
    own square's sum and its sum with the label, off the tiles of its row."""
    width = d + d * d if interactions else d

    def rows(batches):
        import pyarrow as pa
        for rb in batches:
            for r in rb.to_pylist():
                i, j = r["i"], r["j"]
                shape = [min((k + 1) * tile, width + 2) - k * tile for k in (i, j)]
                m, out = np.array(r["vec"]).reshape(shape), []
                for a, b, z in [(i, j, m)] + [(j, i, m.T)] * (i != j):
                    k, cols = a * tile + np.arange(z.shape[0]), b * tile + np.arange(z.shape[1])
                    real = k < width
                    own = np.where(cols[None, :] == k[:, None], z, 0).sum(1)
                    label = z[:, cols == width + 1].sum(1)
                    out.append((k[real], z[:, cols < width].sum(1)[real], own[real], label[real]))
                f, total, own, label = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array([r[by]] * len(f), pa.string()), pa.array(f, pa.int64()), pa.array(total), pa.array(own), pa.array(label)],
                                                 names=[by, "feature", "row_sum", "square_sum", "label_sum"])
    parts = frame.select(by, "i", "j", "vec").mapInArrow(rows, f"`{by}` string, feature long, row_sum double, square_sum double, label_sum double")
    return parts.groupBy(by, "feature").agg(*[F.sum(c).alias(c) for c in ("row_sum", "square_sum", "label_sum")])
