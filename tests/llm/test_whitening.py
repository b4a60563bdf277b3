import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchspark.llm import whitening
from pitchspark.llm.common import written

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Whole numbers, exact sums, and the covariance's eigenvectors from the centred rows' singular values, on one machine."""
    kept = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] + [100_000] * (dims - len(v)) for _, v in kept], dtype=object)
    n, s = len(kept), x.sum(axis=0)
    d = (n * x - s).astype(object)
    c = (d / n).astype(float)
    _, sigma, v = np.linalg.svd(c, full_matrices=False)
    return [i for i, _ in kept], n, (d * d).sum(axis=1).tolist(), c, sigma**2 / n, v.T


def compare(spark, rows, components):
    got = whitening.whitened_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    ids, n, deviation, c, e, v = brute(rows)
    assert len(got) == len(ids) * components
    at = lambda p: (str(p[0]), round(p[1], 6))
    for j in range(components):
        w = c @ v[:, j] / np.sqrt(e[j])
        mine = sorted(((r.vec_id, r.whitened) for r in got if r.component == j + 1), key=at)
        off = [max(abs(p[1] - q[1]) for p, q in zip(mine, sorted(zip(ids, sign * w, strict=True), key=at), strict=True)) for sign in (1, -1)]
        assert min(off) < 1e-8
    assert sorted(str((r.vec_id, r.deviation)) for r in got if r.component == 1) == sorted(str(x) for x in zip(ids, deviation, strict=True))
    assert all(r.n == n and abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9 and r.identity_error < 1e-9 for r in got)


def test_equals_eigenvectors_of_the_covariance(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(300, 12)) * np.linspace(1, 4, 12) @ rnd.normal(size=(12, 12))
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(base.tolist())]
    rows[3] = (3, None, 1)
    rows[4] = (4, [None, *rows[4][1][1:]], 1)
    rows[5] = (5, [float("nan"), *rows[5][1][1:]], None)
    rows[6] = (6, [float("inf"), *rows[6][1][1:]], None)
    rows[7] = (7, rows[7][1][:9], None)  # shorter: padded by zeros
    rows.append(rows[10])  # a repeated row
    rows.append((None, rows[11][1], 2))
    compare(spark, rows, 8)


def test_nearly_dependent_dimensions(spark):
    """Eigenvalues eight orders apart: one Cholesky pass alone would lose them."""
    rnd = np.random.default_rng(2)
    a = rnd.normal(size=(400, 3))
    base = np.hstack([1000 * a, 1000 * a[:, :1] + 0.02 * rnd.normal(size=(400, 1))])
    compare(spark, [(i, v, 0) for i, v in enumerate(base.tolist())], 4)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)], [(i, [0.5, 0.25], 1) for i in range(5)], [(1, [], 0), (2, [], 1)], [(1, None, None)]])
def test_without_variance_nothing_returns(spark, rows):
    assert whitening.whitened_embeddings(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_fewer_components_than_eight_and_clashing_columns(spark):
    rows = [(i, [float(i % 5), float(i % 3), 2.0], 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("a")).withColumn("component", F.lit(0)).withColumn("n", F.lit(None))
    got = whitening.whitened_embeddings(df).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 80
    assert got[0].identity_error < 1e-9


def test_passes_orthogonalise(spark):
    """R^T R is the Gram matrix, and the rows through R^-1 have orthonormal columns."""
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(500, 6)) @ rnd.normal(size=(6, 6)) * 3
    rows = written(whitening.whole_numbers(spark.createDataFrame([(i, v, 0) for i, v in enumerate(base.tolist())], SCHEMA), "vec_id", "embedding"), "test-vectors")
    x = np.array([r.x for r in rows.collect()])
    r = whitening.orthogonal_factor(rows, len(x), x.sum(axis=0))
    c = whitening.centred(x, len(x), x.sum(axis=0))
    assert np.allclose(np.triu(r), r) and np.allclose(r.T @ r, c.T @ c, rtol=1e-12)
    q = whitening._solve(c, r)
    assert np.abs(q.T @ q - np.eye(6)).max() < 1e-12


def test_deviation_is_exact_or_null():
    fit = whitening.Whitening(3, np.array([3, 6]), np.eye(2), np.ones(2), 2.0, np.zeros(2), 0.0)
    assert whitening.deviations(np.array([[1, 2], [2, 2]]), fit) == [0, 9]
    assert whitening.deviations(np.array([[2**40, 2]]), fit) == [None]
    big = whitening.deviations(np.array([[10**9 // 3 * 3, 2]]), fit)
    assert big == [(3 * (10**9 // 3 * 3) - 3) ** 2]
