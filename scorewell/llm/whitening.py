"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors become integers ``x = floor(1024 c) + 100000``.  Sums and the scatter of
centred vectors are added up inside tasks and then per cell by Spark, so the
driver sees numbers per dimension and per pair of dimensions only, whatever the
number of rows.  The scatter is factored as ``P L L' P'`` by Cholesky with the
largest remaining diagonal as pivot; one-sided Jacobi rotates the columns of L
until they are orthogonal.  Squared column norms are then the eigenvalues and
normalised columns the components; no product L'L is formed, which keeps small
eigenvalues to full relative precision.  Centring uses the exact integer sums,
before any product.

Defined results: a row whose vector is null, empty, or holds a null or non-finite
entry is left out; repeated rows count each; null ids pass through; with fewer
than ``k`` eigenvalues above rounding (one row, equal rows) there are as many
components as that, possibly none; an empty table gives no rows; equal
eigenvalues keep the order of the factor; only the named columns are read.
Vectors of different lengths, and entries beyond 2**30, are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 40


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with ``a[order][:, order] = factor @ factor.T``; the factor is
    lower triangular with as many columns as the rank."""
    a = np.array(a, float)
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    left = a.diagonal().copy()
    floor = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= floor:
            return factor[:, :k], order
        order[[k, p]], left[[k, p]] = order[[p, k]], left[[p, k]]
        factor[[k, p]] = factor[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        rest = slice(k + 1, d)
        factor[rest, k] = (a[order[rest], order[k]] - factor[rest, :k] @ factor[k, :k]) / factor[k, k]
        left[rest] -= factor[rest, k] ** 2
    return factor, order


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``g`` rotated until orthogonal.  Each round of a sweep rotates
    disjoint pairs (a round robin), all at once."""
    g = np.array(g, float)
    r = g.shape[1]
    m = r + r % 2
    small = np.finfo(float).eps
    for _ in range(sweeps):
        ring, worst = list(range(1, m)), 0.0
        for _round in range(m - 1):
            line = [0, *ring]
            i, j = np.array(line[:m // 2], int), np.array(line[:m // 2 - 1:-1], int)
            real = (i < r) & (j < r)
            i, j = i[real], j[real]
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(float).tiny))
            worst = max(worst, off.max(initial=0.0))
            turn = off > small
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, i], g[:, j] = c * a - c * t * b, c * t * a + c * b
            ring = ring[-1:] + ring[:-1]
        if worst <= 4 * small * max(1, len(g)):
            break
    return g


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a scatter matrix; the
    entry of largest size in each vector is positive."""
    factor, order = pivoted_cholesky(scatter)
    g = one_sided_jacobi(factor)
    values = (g * g).sum(0)
    by = np.argsort(-values, kind="stable")
    values, g = values[by], g[:, by]
    vectors = np.zeros_like(g)
    vectors[order] = g / np.sqrt(values)
    lead = np.abs(vectors).argmax(0)
    return values, vectors * np.sign(vectors[lead, np.arange(len(by))])


@dataclass(frozen=True)
class Whitening:
    """Fitted numbers: ``n`` rows, exact ``sums``, eigenvalues and components of the
    covariance, its trace, and the widest distance of an entry from its mean."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    reach: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centred(x) @ (self.components[:, :k] / np.sqrt(self.values[:k]))


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n: whole parts are subtracted as integers."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _vectors(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Sound rows of a list column, and (their row numbers, integer matrix) per vector length."""
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    bad = flat.is_null().to_numpy(zero_copy_only=False)
    entry = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = bad | ~np.isfinite(entry)
    row = np.repeat(np.arange(len(size)), size)
    sound = size > 0
    sound[row[bad]] = False
    out = []
    for d in np.unique(size[sound]):
        rows = np.flatnonzero(sound & (size == d))
        x = np.floor(SCALE * entry[np.isin(row, rows) if len(rows) < len(size) else slice(None)].reshape(len(rows), d))
        if np.abs(x).max() > LIMIT:
            raise ValueError(f"an entry is beyond {LIMIT // SCALE} in size")
        out.append((rows, x.astype(np.int64) + SHIFT))
    return np.flatnonzero(sound), out


def _sums(vectors: DataFrame) -> list:
    """Per (length, dimension): rows, exact sum, least and largest entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple] = {}
        for b in batches:
            for _rows, x in _vectors(b.column(0))[1]:
                n, s, lo, hi = have.get(x.shape[1], (0, 0, x[0], x[0]))
                have[x.shape[1]] = n + len(x), s + x.sum(0), np.minimum(lo, x.min(0)), np.maximum(hi, x.max(0))
        for d, (n, s, lo, hi) in have.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(np.full(d, n)),
                                              pa.array(s), pa.array(lo), pa.array(hi)], names=["d", "i", "n", "s", "lo", "hi"])

    parts = vectors.mapInArrow(run, "d bigint, i bigint, n bigint, s bigint, lo bigint, hi bigint")
    return parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
        .orderBy("d", "i").collect()  # a few numbers per dimension


def _scatter(vectors: DataFrame, size: int, centred) -> np.ndarray:
    """Sum of outer products of what ``centred`` makes of the vectors; the last row
    and column hold plain sums."""
    iu = np.triu_indices(size + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for b in batches:
            for _rows, x in _vectors(b.column(0))[1]:
                y = np.column_stack([centred(x), np.ones(len(x))])
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(iu[0] * (size + 1) + iu[1]), pa.array(total[iu])], names=["cell", "v"])

    cells = vectors.mapInArrow(run, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()  # per pair of dimensions
    out = np.zeros((size + 1) ** 2)
    out[[r["cell"] for r in cells]] = [r["v"] for r in cells]
    out = out.reshape(size + 1, size + 1)
    return out + np.triu(out, 1).T


def fit(df: DataFrame, vector: str = "embedding") -> Whitening | None:
    """Eigenvalues and components over all sound rows; None if there is none."""
    vectors = df.select(F.col(vector).alias("v"))
    rows = _sums(vectors)
    if not rows:
        return None
    if len({r["d"] for r in rows}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r['d'] for r in rows})}")
    n, sums, d = rows[0]["n"], tuple(r["s"] for r in rows), len(rows)
    scatter = _scatter(vectors, d, lambda x: _centred(x, n, sums))[:d, :d]
    values, components = eigen(scatter)
    reach = max(max(abs(n * r["lo"] - r["s"]), abs(n * r["hi"] - r["s"])) for r in rows)
    return Whitening(n, sums, values / n, components, float(np.trace(scatter)) / n, reach)


def identity_error(df: DataFrame, model: Whitening, k: int, vector: str = "embedding") -> float:
    """Largest entry of (covariance of the whitened rows - identity), measured on the rows."""
    k = min(k, len(model.values))
    if not k:
        return 0.0
    s = _scatter(df.select(F.col(vector).alias("v")), k, lambda x: model.project(x, k)) / model.n
    mean = s[:k, k]
    return float(np.abs(s[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening | None = None, k: int = 8, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error):
    one per sound vector and component.

    ``deviation`` is exact: bigint where every possible value fits, else decimal(38,0).
    """
    model = model or fit(df, vector)
    src = df.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("v"))
    wide = model is not None and model.reach ** 2 * len(model.sums) >= 1 << 63
    schema = f"vec_id {src.schema[0].dataType.simpleString()}, component int, n bigint, " \
             f"deviation {'decimal(38,0)' if wide else 'bigint'}, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    k = min(k, len(model.values))
    error = identity_error(df, model, k, vector)
    share = model.values[:k] / model.trace
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([s % model.n for s in model.sums], np.int64)

    def deviation(x: np.ndarray) -> pa.Array:
        y, n = x - whole, model.n
        if not wide:
            return pa.array(((n * y - rest) ** 2).sum(1))
        small = int(np.abs(y).max()) ** 2 * y.shape[1] < 1 << 63
        square = ((y * y).sum(1) if small else (y.astype(object) ** 2).sum(1)).tolist()
        cross, last = (y.astype(object) @ rest.astype(object)).tolist(), sum(int(r) ** 2 for r in rest)
        return pa.array([n * n * a - 2 * n * b + last for a, b in zip(square, cross)], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in _vectors(b.column(1))[1]:
                at = pa.array(np.repeat(np.arange(len(rows)), k))
                m = len(rows) * k
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(m, model.n)), deviation(x).take(at), pa.array(model.project(x, k).ravel()),
                     pa.array(np.tile(share, len(rows))), pa.array(np.full(m, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return src.mapInArrow(run, schema)
