"""J9 over sparse rows, exact regression."""

import numpy as np
import pytest

from lodestar.operators import stats as ST


def dense(rows, size):
    x = np.zeros((len(rows), size))
    for k, (pos, val) in enumerate(rows):
        for p, v in zip(pos or [], val or [], strict=True):
            x[k, p] = v
    return x


@pytest.mark.parametrize("head,limit", [(8, 50), (40, 7), (64, 1 << 20), (1, 1)])
def test_blocks_are_the_dense_product(spark, head, limit, monkeypatch):
    # Functions sent to tasks read the module there, so the limit only changes the driver's pure helper.
    monkeypatch.setattr(ST, "PAIR_LIMIT", limit)
    rng = np.random.default_rng(head)
    size, rows = 64, [([], []), (None, None), ([63], [2.0]), ([0, 63], [0.0, 1.0])]
    for _ in range(600):
        p = np.sort(rng.choice(size, rng.integers(0, 30), replace=False))
        rows.append((p.tolist(), rng.integers(-3, 4, len(p)).astype(float).tolist()))
    rows.append((list(range(size)), [1.0] * size))
    df = spark.createDataFrame(rows, "pos array<int>, x array<double>").repartition(3)
    got = {(r.i, r.j): r.g for r in ST.gram_blocks(df, size, head).collect()}
    x = dense(rows, size)
    together = (x != 0).astype(int).T @ (x != 0)
    want = {(i, j): (x.T @ x)[i, j] for i in range(size) for j in range(i, size) if together[i, j]}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert any(v == 0 for v in want.values())           # cells that cancel out are still cells


def test_tail_pairs_come_in_bounded_chunks(monkeypatch):
    monkeypatch.setattr(ST, "PAIR_LIMIT", 10)
    row, pos = np.repeat([0, 1], [12, 3]), np.concatenate([np.arange(12), [0, 5, 9]])
    chunks = list(ST._tail_pairs(row, pos, np.ones(15), 4))
    assert max(len(c[0]) for c in chunks) <= 12 and len(chunks) > 4
    pairs = sorted((int(a), int(b)) for i, j, _ in chunks for a, b in zip(i, j, strict=True))
    want = sorted([(a, b) for b in range(4, 12) for a in range(b + 1)] + [(0, 5), (5, 5), (0, 9), (5, 9), (9, 9)])
    assert pairs == want


def test_no_rows(spark):
    assert ST.gram_blocks(spark.createDataFrame([], "pos array<int>, x array<double>"), 20_000).collect() == []


def test_exact_regression_far_from_zero(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(1e8, 1.0, 500), rng.normal(-5e6, 3.0, 500)
    y = 2.0 * a - 0.5 * b + 7.0 + rng.normal(0, 0.01, 500)
    rows = [(float(p), float(q), float(2 * p), 4.0, float(r)) for p, q, r in zip(a, b, y, strict=True)] + [(None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, twice double, fixed double, y double")
    fit = ST.exact_regression(df, ["a", "b"], "y")
    want = np.linalg.lstsq(np.column_stack([a - a.mean(), b - b.mean()]), y - y.mean(), rcond=None)[0]
    assert np.allclose(fit.coefficients, want, rtol=1e-6) and fit.n == 500 and fit.rank == 2
    assert fit.condition < 2 and fit.r2 > 0.999
    # Dependent and constant columns get no weight, the others keep the fit.
    more = ST.exact_regression(df, ["a", "twice", "fixed", "b"], "y")
    assert more.rank == 2 and more.coefficients[2] == 0
    assert abs(more.coefficients[0] + 2 * more.coefficients[1] - want[0]) < 1e-5
    assert ST.exact_regression(df.limit(0), ["a"], "y").rank == 0


def test_pivoted_cholesky_factors():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(9, 5))
    a = x.T @ x
    low, order = ST.pivoted_cholesky(a)
    assert np.allclose(low @ low.T, a[np.ix_(order, order)])
    assert np.linalg.cond(a) > 1 and low.shape == (5, 5)
