"""Whitening of embeddings by principal components.

Vectors are rounded to integers x (``scale`` times each entry, floored, moved by ``shift``), so that their number n and
sums S are exact. The centred scatter matrix (sum of (x - S/n)(x - S/n)') comes from one product per batch, added
up per task and then level by level. Its eigenvectors come from a pivoted Cholesky factor L (scatter = L L') by one-sided Jacobi:
columns of the triangular factor are rotated in pairs until all are at right angles; then their squared norms are
the eigenvalues and the normalised columns the eigenvectors. This keeps small eigenvalues accurate.

Every task sends one d x d matrix (d: the vectors' length); the driver holds one, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tree import tree_sum
from ..session import cut_lineage
from .common import stored

#: Entries of a batch that are turned into doubles at once.
CHUNK = 1 << 21
MOST_DIGITS = 10 ** 38


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x r) with a = L L' for a positive semidefinite ``a``; r is the numerical rank. The largest
    remaining diagonal entry is the next pivot; rows stay in the order of ``a``."""
    d = len(a)
    rest, out = np.diag(a).copy(), []
    floor = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    for _ in range(d):
        p = int(rest.argmax())
        if rest[p] <= floor:
            break
        col = a[:, p] - sum((c * c[p] for c in out), np.zeros(d))
        col = col / np.sqrt(rest[p])
        col[rest == -np.inf] = 0.0  # rows already taken as pivots
        out.append(col)
        rest = rest - col * col
        rest[p] = -np.inf
    return np.array(out).T.reshape(d, len(out))


def one_sided_jacobi(factor: np.ndarray, most_sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling, and unit eigenvectors as columns) of factor factor'. Each round of a sweep rotates disjoint
    pairs of columns; sweeps go on until all cosines are at rounding error or no longer fall."""
    u = factor.copy()
    r = u.shape[1]
    ring, before = np.arange(r + r % 2), np.inf
    for _ in range(most_sweeps if r > 1 else 0):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = ring[:len(ring) // 2], ring[::-1][:len(ring) // 2]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            a, b = (u[:, p] ** 2).sum(0), (u[:, q] ** 2).sum(0)
            g = (u[:, p] * u[:, q]).sum(0)
            cosine = np.abs(g) / np.sqrt(a * b)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > 1e-17
            p, q, a, b, g = p[turn], q[turn], a[turn], b[turn], g[turn]
            zeta = (b - a) / (2 * g)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            u[:, p], u[:, q] = c * u[:, p] - c * t * u[:, q], c * t * u[:, p] + c * u[:, q]
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if worst < 1e-15 or worst < 1e-13 and worst >= before:
            break
        before = worst
    values = (u ** 2).sum(0)
    order = np.argsort(-values, kind="stable")
    values, u = values[order], u[:, order] / np.sqrt(values[order])
    lead = np.abs(u).argmax(0) if r else np.empty(0, int)
    return values, u * np.sign(u[lead, np.arange(r)])


@dataclass
class Whitening:
    """What was fitted: exact count and sums, eigenvalues of the covariance (falling), unit components (columns)."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: int
    shift: int
    drift: np.ndarray  # mean of the centred vectors: rounding error only

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """S/n as whole part, remainder r (S = n * whole + r) and fraction."""
        whole = [s // self.n for s in self.sums]
        left = [s - self.n * w for s, w in zip(self.sums, whole)]
        return np.array(whole, np.int64), np.array(left, object), np.array([x / self.n for x in left])


def _vectors(column: pa.Array, dim: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are whole vectors of ``dim`` finite entries, x of those rows as longs)."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = sizes == dim
    at = np.flatnonzero(fits)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    # A null entry becomes NaN here, which is dropped as well.
    x = np.floor(scale * flat.to_numpy(zero_copy_only=False).reshape(len(at), dim))
    with np.errstate(invalid="ignore"):
        whole = (np.abs(x) < 2.0 ** 62).all(axis=1)
    fits[at[~whole]] = False
    return fits, x[whole].astype(np.int64) + shift


def _chunks(batches: Iterator[pa.RecordBatch], dim: int, scale: int, shift: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    rows = max(1, CHUNK // max(dim, 1))
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            part = batch.slice(i, rows)
            fits, x = _vectors(part.column(1), dim, scale, shift)
            yield part.column(0).filter(pa.array(fits)), x


def _added(rows: DataFrame, per_task, kind: str) -> np.ndarray | None:
    """The tasks' vectors (``per_task``: batches -> vector or None) added up, on the driver: of a fixed length."""
    def run(batches):
        from pyspark import TaskContext
        v = per_task(batches)
        if v is not None:
            arrow = pa.list_(pa.float64() if kind == "double" else pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([v], arrow)], ["_id", "v"])

    parts = cut_lineage(rows.mapInArrow(run, f"_id long, v array<{kind}>"))
    last = parts.agg(F.max("_id")).first()[0]
    if last is None:
        return None
    return np.array(tree_sum(parts, last + 1).first()["v"])


def fit_whitening(rows: DataFrame, scale: int = 64, shift: int = 1_000_000, most: int = 32) -> Whitening | None:
    """``rows``: (id, vector). All vectors are fitted that ``whiten`` returns; None if there are none."""
    vector = F.col(rows.columns[1])
    size = F.size(vector)
    lengths = rows.where(vector.isNotNull() & (size > 0)).where(
        F.forall(vector, lambda v: v.isNotNull() & (F.abs(v.cast("double") * scale) < F.lit(2.0 ** 62))))
    found = lengths.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if found is None:
        return None
    dim = found["d"]

    def counted(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for _, x in _chunks(batches, dim, scale, shift):
            n += len(x)
            high += (x >> 31).sum(axis=0)
            low += (x & (2 ** 31 - 1)).sum(axis=0)
            high, low = high + (low >> 31), low & (2 ** 31 - 1)
        return np.concatenate([[n], high, low]) if n else None

    total = _added(rows, counted, "long")
    n = int(total[0])
    sums = [(int(h) << 31) + int(w) for h, w in zip(total[1:dim + 1], total[dim + 1:])]
    fitted = Whitening(n, sums, np.empty(0), np.empty((dim, 0)), 0.0, scale, shift, np.zeros(dim))
    whole, _, part = fitted.centre()

    def scattered(batches):
        out, drift = np.zeros((dim, dim)), np.zeros(dim)
        for _, x in _chunks(batches, dim, scale, shift):
            c = (x - whole) - part
            out += c.T @ c
            drift += c.sum(axis=0)
        return np.concatenate([out.ravel(), drift])

    total = _added(rows, scattered, "double")
    fitted.drift = total[dim * dim:] / n
    scatter = total[:dim * dim].reshape(dim, dim)
    scatter = (scatter + scatter.T) / 2 - n * np.outer(fitted.drift, fitted.drift)
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
    fitted.values, fitted.components, fitted.trace = values[:most] / n, vectors[:, :most], float(np.trace(scatter)) / n
    return fitted


def _projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    whole, _, part = w.centre()
    return ((x - whole) - part) @ (w.components / np.sqrt(w.values))


def _deviations(x: np.ndarray, w: Whitening) -> list[Decimal | None]:
    """Sum over dimensions of (n x - S)^2 as exact integers; null beyond 38 digits."""
    whole, left, _ = w.centre()
    k = x - whole
    if int(np.abs(k).max(initial=0)) ** 2 * w.dim < 2 ** 62 and int(np.abs(k).max(initial=0)) * w.n * w.dim < 2 ** 62:
        squares, cross = (k * k).sum(axis=1).astype(object), (k @ left.astype(np.int64)).astype(object)
    else:
        k = k.astype(object)
        squares, cross = (k * k).sum(axis=1), (k * left).sum(axis=1)
    own = int((left * left).sum())
    return [Decimal(v) if v < MOST_DIGITS else None for v in (w.n * w.n * squares - 2 * w.n * cross + own)]


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened vectors - identity), from the whitened vectors themselves."""
    r, mean = len(w.values), w.drift @ (w.components / np.sqrt(w.values))

    def scattered(batches):
        out = np.zeros((r, r))
        for _, x in _chunks(batches, w.dim, w.scale, w.shift):
            z = _projected(x, w) - mean
            out += z.T @ z
        return out.ravel()

    return float(np.abs(_added(rows, scattered, "double").reshape(r, r) / w.n - np.eye(r)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000,
           most: int = 32) -> DataFrame:
    """One row per vector and component: (id_col, component from 1, n, deviation decimal(38,0), whitened, explained, identity_error).

    Left out: null and empty vectors, vectors with a null or non-finite entry or one beyond a long, and, as there is no covariance between
    vectors of different lengths, those of any but the commonest length (the longer one in a tie). There are as many components as the
    covariance has rank, at most ``most``: a table of equal vectors (or of one) gives an empty result, as does an empty table. Equal
    eigenvalues have any orthogonal components. Null ids and repeated rows count and come back as they came. Other columns are ignored.
    """
    rows = stored(vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")))
    w = fit_whitening(rows, scale, shift, most)
    kind = vectors.schema[id_col].dataType.simpleString()
    if w is None or not len(w.values):
        empty = f"{id_col} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    error = identity_error(rows, w)

    def projected(batches):
        for ids, x in _chunks(batches, w.dim, w.scale, w.shift):
            z = _projected(x, w)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(_deviations(x, w), pa.decimal128(38, 0)), pa.array(list(z), pa.list_(pa.float64()))], ["_id", "deviation", "z"])

    out = rows.mapInArrow(projected, f"_id {kind}, deviation decimal(38,0), z array<double>")
    out = out.select("_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    share = F.lit([float(v) for v in w.values / w.trace])
    return out.select(F.col("_id").alias(id_col), (F.col("k") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(share, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
