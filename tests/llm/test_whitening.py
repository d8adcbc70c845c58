"""Whitening: the eigen solver and the report against numpy's own solver over the same vectors."""

import math

import numpy as np
import pytest

from docharbor.llm.whitening import deviations, eigen, exactly, fit, polar, scaled, whiten, whitening_report

SCHEMA = "vec_id long, embedding array<float>, label int, EMBEDDING string"


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [0.0] * 4,
        [2.0] * 5,
        [5.0] * 3 + [1.0] * 4 + [0.0] * 3,
        list(np.logspace(3, -9, 40)),
        [1 + 1e-14 * i for i in range(6)],
        [-2.0, 0.0, 2.0, 4.0],
    ],
)
def test_components_of_a_matrix(values):
    v = symmetric(np.random.default_rng(3), values)
    v = (v + v.T) / 2
    found, basis = eigen(v)
    size = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-13 * size
    assert np.abs(basis.T @ basis - np.eye(len(v))).max() < 1e-13
    assert np.abs(v @ basis - basis * found).max() < 1e-13 * size


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(4)
    a = symmetric(rng, [4.0, 1e-6, -1e-9, -7.0])
    w, q = np.linalg.eigh(a)
    assert np.abs(polar(a) - (q * np.sign(w)) @ q.T).max() < 1e-5
    a = symmetric(rng, [4.0, 0.5, -0.25, -7.0])
    w, q = np.linalg.eigh(a)
    assert np.abs(polar(a) - (q * np.sign(w)) @ q.T).max() < 1e-13


def made(rng, n=400, d=20):
    rows = [(i, [float(c) for c in rng.standard_normal(d) * np.linspace(2, 0.1, d) + 0.3], 1, "x") for i in range(n)]
    rows += [(1000 + i, rows[7][1], 1, "x") for i in range(300)] + [rows[3], rows[3]]
    rows += [(None, rows[9][1], 1, "x"), (2000, None, 1, "x"), (2001, [None] + rows[0][1][1:], 1, "x")]
    rows += [(2002, [math.nan] + rows[0][1][1:], 1, "x"), (2003, [math.inf] * d, 1, "x"), (2004, [1.0], 1, "x"), (2005, [], 1, "x")]
    return rows


def test_report_against_plain_numbers(spark):
    rows = made(np.random.default_rng(5))
    left = [r for r in rows if r[1] and len(r[1]) == 20 and all(c is not None and math.isfinite(c) for c in r[1])]
    x = {r[0]: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in left}
    distinct = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, total = len(distinct), distinct.sum(0)
    centre = (distinct * n - total).astype(float) / n
    v = centre.T @ centre / n
    w, q = np.linalg.eigh(v)
    w, q = w[::-1], q[:, ::-1]
    found = whitening_report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(found) == 16 * len(left)
    signs = {}
    for r in found:
        exact = np.array(x[r.vec_id], dtype=object) * n - total
        assert (r.n, r.deviation) == (n, int((exact * exact).sum()))
        j = r.component - 1
        want = float(exact.astype(float) / n @ q[:, j] / np.sqrt(w[j]))
        if abs(want) > 1e-6:
            signs.setdefault(j, np.sign(want * r.whitened))
        assert abs(r.whitened - signs.get(j, 1) * want) < 1e-9
        assert abs(r.explained - w[j] / np.trace(v)) < 1e-12 and r.identity_error < 1e-10


def test_vectors_without_variance_and_of_few_dimensions(spark):
    same = whitening_report(spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(5)], SCHEMA)).collect()
    assert len(same) == 10 and all(r.deviation == 0 and r.n == 1 for r in same)
    assert all(r.whitened is None and r.explained is None and r.identity_error is None for r in same)
    line = whitening_report(spark.createDataFrame([(i, [float(i), 2.0, 0.0], 1, "x") for i in range(4)], SCHEMA)).collect()
    assert sorted({r.component for r in line}) == [1, 2, 3]
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    assert abs(sum(r.whitened**2 for r in line if r.component == 1) / 4 - 1) < 1e-12
    assert whitening_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening_report(spark.createDataFrame([(1, None, 1, "x"), (2, [], 1, "x")], SCHEMA)).collect() == []


def test_whole_numbers_of_any_size(spark):
    x = np.array([[1 << 61, 5], [3, -(1 << 60)]])
    sums = [int(s) for s in x.astype(object).sum(0)]
    exact = exactly(x, 2, sums)
    assert exact.tolist() == [[2 * int(a) - s for a, s in zip(row, sums)] for row in x.tolist()]
    assert deviations(exact) == [None, None] and deviations(np.array([[3, 4], [0, -1]])) == [25, 1]
    far = scaled(spark.createDataFrame([(1, [3e38, 0.0], 1, "x"), (2, [-3e38, 1.0], 1, "x"), (3, [1.0, 1.0], 1, "x")], SCHEMA), "vec_id", "embedding")
    fitted = fit(far)
    assert fitted.n == 3 and whiten(far, fitted).count() == 3
