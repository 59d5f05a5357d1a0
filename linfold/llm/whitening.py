"""Embedding whitening by incremental eigendecomposition.

Entries become integers x = floor(``SCALE`` * c) + ``SHIFT``; the fit list holds
each distinct x vector once, n of them with per-dimension sums S.

1. Each task holds the spectrum of what it has seen: count, mean, eigenvalues and
   eigenvectors of the scatter about that mean. A vector is a centred rank-one
   update: the scatter grows by k/(k+1) d d', d its difference from the mean of
   the k before. The new eigenvalues are the roots of the secular equation
   1 + rho sum z_j^2 / (d_j - t) = 0, one between every two neighbours, found for
   all at once as offsets from the nearer pole; eigenvectors come from the z
   for which these roots are exact, so they stay orthogonal. Before that the
   problem is deflated: equal eigenvalues are turned until one of them carries
   their part of z, and components without z stay as they are.
2. Spectra are combined, ``FAN`` at a time and level by level, by successive rank-one
   updates: one for each eigenvector of the other spectrum and one for the
   difference of the means. A row is a spectrum, so their size doesn't grow with
   the table; one comes to the driver in the end (width^2 numbers).
3. Rayleigh-Ritz: a pass over the fit list projects every vector on the basis
   and sums the outer products, whose eigenvectors turn the basis. A further
   pass measures the covariance of the whitened vectors, which is the reported
   identity error; the basis is turned again while that is over ``GOAL``.
4. Every row is projected on the first components, over the roots of their
   eigenvalues.

Defined results: vectors that are null or hold a null, NaN or infinite entry are
left out, as are empty ones and those whose width is not the one that most fit
vectors have (of several the least width). Components whose eigenvalue is zero to
rounding (under ``RANK`` of the largest) can't be scaled and are left out, so a
table of one vector gives no rows. Repeated vectors count once in the fit list;
repeated rows and vec_ids each get their own result rows. ``deviation`` is exact,
and null beyond 64 bits; scaled entries beyond 2^40 count as that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.common import staged

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
FAN = 64  # spectra that one group combines
GOAL = 1e-9  # identity error at which the basis is good
ROUNDS = 4  # projections at most
RANK = 1e-12
LIMIT = 2.0 ** 40  # of scaled entries
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Of diag(d) + rho z z' (d ascending, distinct; all z2 = z^2 > 0; rho > 0):
    (the pole next to each eigenvalue, the eigenvalue's offset from it)."""
    n = len(d)
    z2 = rho * z2
    gap = np.append(d[1:] - d[:-1], z2.sum())
    # the half of its interval that a root lies in gives its pole
    far = d[None, :] - d[:, None]  # poles as seen from each interval's left end
    mid = gap / 2
    left = 1 + (z2 / (far - mid[:, None])).sum(1) >= 0
    left[-1] = True
    origin = np.arange(n) + ~left
    delta = d[None, :] - d[origin][:, None]
    low, high = np.where(left, 0.0, -mid), np.where(left, mid, 0.0)
    high[-1] = gap[-1]
    behind = np.tri(n)  # poles up to the interval's left end
    i = np.arange(n)
    a, b = delta[i, i], np.append(delta[i[:-1], i[1:]], np.inf)
    last = ~np.isfinite(b)
    t = (low + high) / 2
    for _ in range(60):
        away = 1 / (delta - t[:, None])
        term = z2 * away
        value = 1 + term.sum(1)
        low, high = np.where(value < 0, t, low), np.where(value < 0, high, t)
        error = np.abs(term).sum(1) + 1
        done = (np.abs(value) <= 4 * _EPS * error) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        # both sides' sums as p/(a - t), q/(b - t) with their slopes, and a constant
        slope = term * away
        psi = np.einsum("ij,ij->i", slope, behind)
        phi = slope.sum(1) - psi
        bt = np.where(last, 1.0, b - t)
        at = a - t
        c = value - at * psi - np.where(last, 0, bt * phi)
        p, q = at * at * psi, np.where(last, 0, bt * bt * phi)
        # c (a - s)(b - s) + p (b - s) + q (a - s) = 0 in s = t + e
        with np.errstate(all="ignore"):
            qa = c
            qb = -(c * (at + bt) + p + q)
            qc = c * at * bt + p * bt + q * at
            root = np.sqrt(np.maximum(qb * qb - 4 * qa * qc, 0))
            big = -0.5 * (qb + np.where(qb >= 0, root, -root))
            steps = np.stack([big / qa, qc / big])
            steps[:, last] = np.where(last, at + p / c, 0)[last]  # one pole only
            new = t + steps
            fits = (new > low) & (new < high)
        step = np.where(fits[0], new[0], np.where(fits[1], new[1], (low + high) / 2))
        t = np.where(done, t, step)
    return origin, t


class Spectrum:
    """Count, mean, eigenvalues (ascending) and eigenvectors (columns) of the scatter."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def rank_one(self, v: np.ndarray, rho: float) -> None:
        """The spectrum of the scatter plus rho v v'."""
        size = float(v @ v) * rho
        if not size > 0:
            return
        d, z = self.values, self.vectors.T @ v
        tiny = 8 * _EPS * max(d[-1], size)
        # deflation: of equal eigenvalues one carries their part of z ...
        starts = np.flatnonzero(np.append(True, np.diff(d) > tiny))
        if len(starts) < len(d):
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(d)], strict=True):
                if b - a > 1 and (norm := np.linalg.norm(z[a:b])) > 0:
                    u = z[a:b].copy()
                    sign = 1.0 if u[-1] >= 0 else -1.0
                    u[-1] += sign * norm
                    block = self.vectors[:, a:b]
                    block -= np.outer(block @ u, 2 / (u @ u) * u)
                    z[a:b] = 0
                    z[b - 1] = -sign * norm
        # ... and what has (nearly) no part of it stays as it is
        live = np.flatnonzero(np.abs(z) * np.sqrt(rho * max(d[-1], size)) > tiny)
        if not len(live):
            return
        dl, zl = d[live], z[live]
        origin, offset = secular_roots(dl, zl * zl, rho)
        # d_j - root_i, without cancellation; then the z for which the roots are exact
        apart = (dl[:, None] - dl[origin][None, :]) - offset[None, :]
        poles = dl[:, None] - dl[None, :]
        np.fill_diagonal(poles, 1)
        exact = np.sqrt(np.abs(np.prod(apart / poles, axis=1))) * np.sign(zl)
        turn = exact[:, None] / apart
        turn /= np.linalg.norm(turn, axis=0)
        d[live] = dl[origin] + offset
        self.vectors[:, live] = self.vectors[:, live] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], self.vectors[:, order]

    def add(self, x: np.ndarray) -> None:
        """One vector."""
        v = x - self.mean
        self.n += 1
        self.mean += v / self.n
        self.rank_one(v, (self.n - 1) / self.n)

    def combine(self, other: Spectrum) -> None:
        """All that the other spectrum has seen."""
        for value, vector in zip(other.values.tolist(), other.vectors.T, strict=True):
            if value > 0:
                self.rank_one(vector, value)
        v, total = other.mean - self.mean, self.n + other.n
        self.rank_one(v, self.n * other.n / total)
        self.mean = self.mean + v * (other.n / total)
        self.n = total

    def row(self) -> dict:
        return {"n": self.n, "mean": self.mean, "eig": self.values, "vec": self.vectors.ravel()}

    @classmethod
    def of(cls, n, mean, eig, vec) -> Spectrum:
        out = cls(len(eig))
        out.n, out.mean, out.values = int(n), np.array(mean), np.array(eig)
        out.vectors = np.array(vec).reshape(len(eig), -1)
        return out


_ROW = "part long, n long, mean array<double>, eig array<double>, vec array<double>"


def _row_table(part: int, s: Spectrum) -> pa.Table:
    lists = pa.list_(pa.float64())
    r = s.row()
    return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([r["n"]], pa.int64()),
                     **{k: pa.array([r[k]], lists) for k in ("mean", "eig", "vec")}})


def _matrix(batch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _spectra(batches, centre: np.ndarray):
    """The spectrum of a task's fit vectors, about the (rounded) centre."""
    from pyspark import TaskContext

    s = Spectrum(len(centre))
    for batch in batches:
        for x in (_matrix(batch, len(centre)) - centre).astype(float):
            s.add(x)
    if s.n:
        yield from _row_table(TaskContext.get().partitionId(), s).to_batches()


def _combined(key, table):
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    out, *rest = [Spectrum.of(r["n"], r["mean"], r["eig"], r["vec"]) for r in rows]
    for s in rest:
        out.combine(s)
    return _row_table(key[0].as_py(), out)


def _spectrum(fit: DataFrame, centre: np.ndarray) -> Spectrum | None:
    rows = staged(fit.mapInArrow(lambda b: _spectra(b, centre), _ROW), "spectra")
    while rows.count() > 1:
        ranked = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
        rows = staged(ranked.groupBy("part").applyInArrow(_combined, _ROW), "spectra")
    got = rows.collect()
    return Spectrum.of(*got[0][1:]) if got else None


def _projected(batches, centre, rest, basis):
    """Sums over a task: the projections' outer products and the projections."""
    total, lead = np.zeros((basis.shape[1],) * 2), np.zeros(basis.shape[1])
    for batch in batches:
        y = ((_matrix(batch, len(centre)) - centre) - rest) @ basis
        total += y.T @ y
        lead += y.sum(0)
    # one row per dimension pair's row, so that sums are spread over reducers
    for k in range(basis.shape[1]):
        yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "vec": pa.array([np.append(total[k], lead[k])], pa.list_(pa.float64()))})


def _projection(fit: DataFrame, centre, rest, basis, n) -> np.ndarray:
    """The covariance of the fit list in the basis."""
    def total(key, table):
        vec = table.column("vec").combine_chunks()
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "vec": pa.array([vec.flatten().to_numpy().reshape(len(vec), -1).sum(0)], pa.list_(pa.float64()))})
    sums = (fit.mapInArrow(lambda b: _projected(b, centre, rest, basis), "k int, vec array<double>")
            .withColumn("part", F.spark_partition_id().cast("long")))
    for fan in (FAN * 16, None):  # by groups of tasks first
        group = sums.withColumn("part", F.floor(F.col("part") / fan)) if fan else sums
        sums = group.groupBy(*["k", "part"] if fan else ["k"]).applyInArrow(total, "k int, vec array<double>")
        sums = sums.withColumn("part", F.lit(0))
    rows = {r["k"]: np.array(r["vec"]) for r in sums.select("k", "vec").collect()}
    both = np.array([rows[k] for k in range(basis.shape[1])])
    mean = both[:, -1] / n
    v = both[:, :-1] / n - np.outer(mean, mean)
    return (v + v.T) / 2


def quantised(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x) of the vectors whose entries are all finite."""
    c = F.col(column)
    good = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (embeddings.where(good).select(F.col(id_column).alias("vec_id"), F.col(column).alias("c"))
            .select("vec_id", F.transform("c", lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(LIMIT)), F.lit(-LIMIT)))
                                          .cast("long") + shift).alias("x")))


class Whitening:
    """A fitted transform: n, S, eigenvalues by falling size and their unit
    vectors (columns), the trace of the covariance and the identity error."""

    def __init__(self, n, sums, values, vectors, trace, error):
        self.n, self.sums, self.values, self.vectors, self.trace, self.error = n, sums, values, vectors, trace, error

    def apply(self, rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
        """(vec_id, component, n, deviation, whitened, explained, identity_error)
        of rows (vec_id, x) of the fitted width."""
        kind = rows.schema["vec_id"].dataType.simpleString()
        schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
        k = min(components, len(self.values))
        if not k:
            return rows.sparkSession.createDataFrame([], schema)
        fixed = (self.n, self.sums, self.values[:k], self.vectors[:, :k], self.trace, self.error)
        return rows.where(F.size("x") == len(self.sums)).mapInArrow(lambda b: _whitened(b, *fixed), schema)


def _whitened(batches, n, sums, values, vectors, trace, error):
    k, width = len(values), len(sums)
    centre = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)  # S = n * centre + rest
    for batch in batches:
        x = _matrix(batch, width) - centre
        white = ((x - rest / n) @ vectors) / np.sqrt(values)
        # (n x - S)^2 = (n (x - centre) - rest)^2, in 64 bits where they suffice
        if len(x) and n * (int(np.abs(x).max()) + 1) * width ** .5 < 2 ** 31.5:
            deviation = ((n * x - rest) ** 2).sum(1)
        else:
            exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in x.tolist()]
            deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
        many = np.repeat(np.arange(len(x)), k)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(many)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
             pa.array(np.full(len(many), n, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(many)), pa.array(white.ravel()),
             pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(many), error))],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of rows (vec_id, x), fitted on each distinct x once."""
    fit = staged(rows.select("x").groupBy("x").count().select("x"), "fit")
    widths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    if not widths:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    width, n = widths[0]
    fit = fit.where(F.size("x") == width)
    parts = fit.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(parts.collect(), key=lambda r: r["k"])]
    centre = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    found = _spectrum(fit, centre)
    basis, error, values = found.vectors[:, ::-1].copy(), np.inf, found.values[::-1] / n
    trace = kept = None
    for turn in range(ROUNDS):
        v = _projection(fit, centre, rest, basis, n)
        if turn:
            kept = int((values > RANK * values[0]).sum()) if values[0] > 0 else 0
            k = min(components, kept)
            white = v[:k, :k] / np.sqrt(np.outer(values[:k], values[:k]))
            error = float(np.abs(white - np.eye(k)).max()) if k else 0.0
            if error <= GOAL:
                break
        trace = float(np.trace(v))
        values, turned = np.linalg.eigh(v)
        values = values[::-1]
        basis = basis @ turned[:, ::-1]
        basis, _ = np.linalg.qr(basis)  # unit and orthogonal to the last digit
    return Whitening(n, sums, values[:kept], basis[:, :kept], trace, error)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The fitted whitening applied to every row with a finite vector."""
    rows = quantised(embeddings)
    return fit_whitening(rows, components).apply(rows, components)
