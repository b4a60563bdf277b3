"""Embedding whitening by shifted CholeskyQR.

A vector's entries ``c`` become whole numbers ``x = floor(SCALE * c) + OFFSET``.
Let X be the rows ``x - S / n`` (S the exact sums of all n rows). Distributed
Gram passes orthogonalise X:

1. ``G = X^T X``, summed from one partial matrix per task. The first factor
   is the Cholesky factor of ``G + s I``; the shift s keeps it from breaking down.
2. Each further pass solves the triangular system ``Q = X R^-1`` for a batch of
   rows at a time, sums ``Q^T Q`` and multiplies its Cholesky factor onto R from the left. Passes end
   when ``Q^T Q`` is the identity to rounding, after three in the usual case.
3. The singular values of R (dims x dims) are those of X, its right singular
   vectors the components: eigenvalue ``e = sigma^2 / n`` of the covariance.

Partial matrices are summed entry by entry in Spark (``dims^2`` rows, whatever
the number of tasks), so the driver holds a few matrices of dims x dims. The
rows themselves stay in a written table and are read once a pass.

Rows with a null vector, or one with null or non-finite entries (or entries
too large for a long), are dropped. Shorter vectors count as padded by
zeros; the longest gives the dimensions. Ties and repeated rows are rows like
others, a null id stays null. Components without variance (fewer rows than
dimensions, constant dimensions; less than 1e-12 of the largest) are not returned,
so a table of equal rows, one row or none gives an empty result. Signs: the entry of
largest size of a component is positive. ``deviation`` is exact, and null where it
exceeds a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: A batch of this many rows is centred and solved at once.
BATCH = 8192
PASSES = 6
_LONG = 2**63
_EPS = float(np.finfo(np.float64).eps)


@dataclass
class Whitening:
    """What the fit gives; arrays of dims or dims x components."""

    n: int
    sums: np.ndarray  # exact, int64
    directions: np.ndarray  # dims x components, unit columns by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    means: np.ndarray  # of the whitened rows, zero but for rounding
    identity_error: float


def usable(vector: Column) -> Column:
    """Vectors without null, non-finite or oversized entries."""
    fit = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < 2.0**50)  # noqa: E731  false for NaN, infinities and nulls
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fit(x), F.lit(False)))


def whole_numbers(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, x (whole numbers) of the usable rows."""
    c = F.col(vector)
    x = F.transform(c, lambda v: (F.floor(v.cast("double") * SCALE) + OFFSET).cast("long"))
    return df.where(usable(c)).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column, dims: int) -> np.ndarray:
    """An Arrow list column as rows of ``dims`` whole numbers; missing ones are those of zero."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    if (size == dims).all():
        return values.reshape(len(column), dims)
    out = np.full((len(column), dims), OFFSET, dtype=np.int64)
    out[np.arange(dims) < size[:, None]] = values
    return out


def _batches(batches, column: int, dims: int) -> Iterator[tuple]:
    """Slices of the Arrow batches of at most BATCH rows: (batch, matrix)."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH):
            part = batch.slice(a, BATCH)
            yield part, _matrix(part.column(column), dims)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, subtracted in whole numbers where they fit, so each entry has one rounding."""
    if n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0)) < 2.0**62:
        return (n * x - sums) / n
    return x - sums / n


def _summed(rows: DataFrame, dims: int, width: int, part) -> np.ndarray:
    """The sum over all rows of ``part(matrix of a batch)``, arrays of one shape: one partial array a task, then by entry."""

    def run(batches):
        import pyarrow as pa

        total = None
        for _, x in _batches(batches, 0, dims):
            here = part(x).ravel()
            total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

    found = rows.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(width)
    for r in found.collect():  # width rows
        out[r.i] = r.v
    return out


def _solve(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``q r^-1`` for an upper triangular r, column by column."""
    out = np.empty_like(q)
    for j in range(r.shape[0]):
        out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of ``gram + shift I``; a shift that does not suffice grows."""
    eye = np.eye(len(gram))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * eye).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 4 * _EPS * len(gram) * float(np.trace(gram)) / len(gram) or 1.0)


def orthogonal_factor(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R (upper triangular) of the centred rows' QR decomposition, by shifted CholeskyQR."""
    dims = len(sums)

    def gram(r: np.ndarray | None) -> np.ndarray:
        def part(x):
            q = centred(x, n, sums)
            q = q if r is None else _solve(q, r)
            return q.T @ q

        g = _summed(rows, dims, dims * dims, part).reshape(dims, dims)
        return (g + g.T) / 2

    g = gram(None)
    norm = float(np.linalg.norm(g, 2))
    if not norm:
        return g
    # 11 (m n + n (n + 1)) u |X|^2 keeps the factor from breaking down; it may not grow past a small share of the norm.
    shift = min(11 * (n * dims + dims * (dims + 1)) * _EPS / 2, 1e-8) * norm
    r = _cholesky(g, shift)
    for _ in range(PASSES):
        g = gram(r)
        r = _cholesky(g, 0.0) @ r
        kept = np.diag(g) > 0.5  # directions without variance stay at zero
        if np.abs(g[np.ix_(kept, kept)] - np.eye(int(kept.sum()))).max(initial=0) < 1e-10:
            break
    return r


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of the rows (vec_id, x) of ``whole_numbers``, a written table; None without variance."""
    at = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("c")).collect()  # one row a dimension
    n, dims = rows.count(), len(at)
    if n < 2 or not dims:
        return None
    sums = np.zeros(dims, dtype=np.int64)
    for row in at:
        sums[row.i] = row.s + OFFSET * (n - row.c)
    r = orthogonal_factor(rows, n, sums)
    _, sigma, v = np.linalg.svd(r)
    e = sigma**2 / n
    m = int((e[:components] > 1e-12 * e[0]).sum()) if e[0] > 0 else 0
    if not m or e[0] < 1e-9:  # whole numbers vary by 1 / n at least
        return None
    directions = v[:m].T
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(m)])
    fit = Whitening(n, sums, directions, e[:m], float(e.sum()), np.zeros(m), 0.0)
    fit.means = _summed(rows, dims, m, lambda x: whitened(x, fit).sum(axis=0)) / n

    def product(x):
        w = whitened(x, fit) - fit.means
        return w.T @ w

    covariance = _summed(rows, dims, m * m, product).reshape(m, m) / n
    fit.identity_error = float(np.abs(covariance - np.eye(m)).max())
    return fit


def whitened(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return centred(x, fit.n, fit.sums) @ fit.directions / np.sqrt(fit.eigenvalues)


def deviations(x: np.ndarray, fit: Whitening) -> list[int | None]:
    """The exact ``sum((n x - S)^2)`` of each row, None beyond a long."""
    reach = fit.n * int(np.abs(x).max(initial=0)) + int(np.abs(fit.sums).max(initial=0))
    if reach < 2**62:
        d = fit.n * x - fit.sums
        if float(np.abs(d).max(initial=0)) ** 2 * max(x.shape[1], 1) < 2.0**62:
            return (d * d).sum(axis=1).tolist()
        d = d.astype(object)
    else:
        d = fit.n * x.astype(object) - fit.sums.astype(object)
    return [s if s < _LONG else None for s in (d * d).sum(axis=1).tolist()]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, fit: Whitening | None) -> DataFrame:
    """One row per row of ``rows`` and component."""
    if fit is None:
        return rows.sparkSession.createDataFrame([], WHITENED)

    def run(batches):
        import pyarrow as pa

        m = len(fit.eigenvalues)
        for part, x in _batches(batches, 1, len(fit.sums)):
            k = len(x)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(k), m)))
            deviation = pa.array(deviations(x, fit), pa.int64()).take(pa.array(np.repeat(np.arange(k), m)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.full(k * m, fit.n)), deviation,
                pa.array(whitened(x, fit).ravel()), pa.array(np.tile(fit.eigenvalues / fit.trace, k)), pa.array(np.full(k * m, fit.identity_error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, WHITENED)


def whitened_embeddings(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of all usable rows of ``df``."""
    rows = written(whole_numbers(df, vec_id, vector), "whole-vectors")
    return whiten(rows, fit_whitening(rows, components))
