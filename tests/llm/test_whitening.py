import math
from fractions import Fraction

import numpy as np
import pytest

from layerhouse.llm import whitening
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF


def brute(rows: list, count: int = 8):
    """(rows of the query by vec_id, eigenvalues, vectors), the covariance from exact integers."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(0)
    apart = n * x - sums
    cov = np.array([[Fraction(int(t), n ** 3) for t in row] for row in apart.T @ apart], object).astype(float)
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1], vectors[:, ::-1]
    projected = (apart / n).astype(float) @ vectors[:, :count] / np.sqrt(e[:count])
    return kept, n, (apart ** 2).sum(1), projected, e[:count] / e.sum(), cov


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    kept, n, deviation, projected, explained, _ = brute(rows)
    found = {(r.vec_id, r.component): r for r in QUERIES["op11_whitening"](spark, SF).collect()}
    assert len(found) == 8 * n == 8 * len(kept)
    sign = [math.copysign(1, found[kept[0][0], c].whitened * projected[0][c - 1]) for c in range(1, 9)]
    for k, (i, _) in enumerate(kept):
        for c in range(1, 9):
            r = found[i, c]
            assert r.n == n and r.deviation == deviation[k] and 0 <= r.identity_error <= 1e-8
            assert r.whitened == pytest.approx(sign[c - 1] * projected[k][c - 1], abs=1e-8)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)


def test_odd_rows(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=3).tolist()) for i in range(40)]
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, math.nan, 2.0]), (103, [math.inf, 0.0, 0.0]), (None, [0.5, 0.5, 0.5]),
             (7, rows[7][1]), (7, rows[7][1])]
    others = [(104, []), (105, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + others, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as component", "3 as `a.b`")
    rows = [(r.vec_id, r.embedding) for r in frame.collect() if r.vec_id not in (104, 105)]
    kept, n, deviation, projected, explained, _ = brute(rows, 3)
    found = whitening.whiten(frame).collect()
    assert len(found) == 3 * n and n == 43
    assert sorted(r.deviation for r in found) == sorted(int(x) for x in np.repeat(deviation, 3))
    assert sorted(abs(r.whitened) for r in found) == pytest.approx(sorted(np.abs(projected).ravel()), abs=1e-8)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]])
def test_nothing_to_scale(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count() == 0


def test_fewer_directions_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 5.0]) for i in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)).collect()
    assert {r.component for r in found} == {1} and len(found) == 50
    assert found[0].explained == pytest.approx(1.0) and found[0].identity_error < 1e-9


def _check(triangle, count=None):
    count = count or len(triangle)
    values, z = whitening.directions(triangle, count)
    true = np.linalg.svd(triangle, compute_uv=False)
    assert np.abs(values - true).max() <= 1e-13 * len(true) * true[0]
    if not z.shape[1]:
        assert true[0] <= 1e-12
        return
    assert np.abs(z.T @ z - np.eye(z.shape[1])).max() < 1e-11
    residual = triangle.T @ (triangle @ z) - z * values[:z.shape[1]] ** 2
    assert np.abs(residual).max() <= 1e-11 * true[0] ** 2


def test_solver_on_many_spectra():
    draw = np.random.default_rng(2)
    for d in (1, 2, 3, 8, 33, 64):
        q, p = (np.linalg.qr(draw.normal(size=(d, d)))[0] for _ in range(2))
        for spectrum in (np.linspace(1, 2, d), np.ones(d), np.repeat([3.0, 1.0], [d // 2, d - d // 2]), 10.0 ** -np.arange(d),
                         np.r_[np.ones(d // 2), np.zeros(d - d // 2)], 1 + 1e-9 * np.arange(d), draw.random(d), np.zeros(d)):
            _check(np.linalg.qr(q * spectrum @ p, mode="r"))
    _check(np.triu(draw.normal(size=(96, 96))), 8)


def test_small_values_of_a_bidiagonal_matrix_keep_their_digits():
    """Each is found to a few digits of rounding of itself, not of the largest."""
    a, b = 10.0 ** -np.arange(0, 24, 3), 10.0 ** -(np.arange(0, 21, 3) + 2.0)
    product = math.prod(a)
    found = whitening.dqds(a, b)
    assert math.prod(found) == pytest.approx(product, rel=1e-13)
    assert found[-1] == pytest.approx(1e-21, rel=1e-2) and found[0] == pytest.approx(1.0, rel=1e-2)
