"""Optimality certificates against dense numpy, and at an optimum."""

import numpy as np
import pytest

from lodestar.operators import certificates as CE
from lodestar.operators import linear as LN


def _data(spark, n=60, size=6):
    rng = np.random.default_rng(3)
    x = np.where(rng.random((n, size)) < 0.5, rng.random((n, size)), 0.0)
    x[0] = 0                                     # a labelled row without features
    y = (rng.random(n) < 0.5).astype(int)
    feats = spark.createDataFrame([(i, int(p), float(x[i, p])) for i in range(n) for p in np.flatnonzero(x[i])], "doc_id long, pos int, x double")
    return x, y, feats, spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, y int")


def test_logistic_is_dense_gradient(spark):
    x, y, feats, labels = _data(spark)
    w = np.linspace(-2, 2, 6)
    t = x @ w
    g = x.T @ (1 / (1 + np.exp(-t)) - y)
    r = CE.logistic_certificate(feats, labels, w).first()
    assert (r.rows, r.loss, r.gradient_norm, r.gradient_max) == pytest.approx(
        (60, (np.log1p(np.exp(t)) - y * t).sum(), np.linalg.norm(g), abs(g).max()))


def test_newton_optimum_is_certified(spark):
    x, y, feats, labels = _data(spark)
    w = np.zeros(6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y))
    assert CE.logistic_certificate(feats, labels, w).first().gradient_norm < 1e-9
    assert CE.logistic_certificate(feats, labels, w + 0.01).first().gradient_norm > 1e-3


@pytest.mark.parametrize("reg", [0.0, 0.5])
def test_hinge_gradient_and_gap(spark, reg):
    x, y, feats, labels = _data(spark)
    w, yp = np.linspace(-1, 3, 6), 2 * y - 1
    bad = yp * (x @ w) < 1
    data = -(x * (yp * bad)[:, None]).mean(axis=0)
    loss = reg / 2 * w @ w + np.maximum(0, 1 - yp * (x @ w)).mean()
    gap = loss - (bad.mean() - data @ data / (2 * reg)) if reg else loss
    r = CE.hinge_certificate(feats, labels, w, reg).first()
    assert (r.loss, r.gradient_norm, r.gap) == pytest.approx((loss, np.linalg.norm(reg * w + data), gap))


def test_gap_closes_where_all_rows_are_violated(spark):
    # With a strong penalty every row stays violated and w = mean(y x) / reg is optimal.
    x, y, feats, labels = _data(spark)
    w = ((2 * y - 1)[:, None] * x).mean(axis=0) / 50.0
    r = CE.hinge_certificate(feats, labels, w, 50.0).first()
    assert r.gradient_norm == pytest.approx(0, abs=1e-12) and r.gap == pytest.approx(0, abs=1e-12)


def test_empty_tables(spark):
    _, _, feats, labels = _data(spark)
    none = CE.hinge_certificate(feats.limit(0), labels.limit(0), np.zeros(6)).first()
    assert (none.rows, none.loss, none.gradient_norm) == (0, 0.0, 0.0)
    assert CE.logistic_certificate(feats.limit(0), labels.limit(0), np.zeros(6)).first().gradient_norm == 0.0


@pytest.mark.parametrize("check", [CE.logistic_certificate, CE.hinge_certificate])
def test_arrays_are_shuffled_not_their_entries(spark, check):
    x, _, feats, labels = _data(spark)
    arrays, w = LN.doc_arrays(feats).localCheckpoint(), np.linspace(-2, 2, 6)
    got = check(arrays, labels, w)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and plan.count("MapInArrow") == 1, plan
    assert tuple(got.first()) == pytest.approx(tuple(check(feats, labels, w).first()))


def test_unknown_and_repeated_labels(spark):
    feats = spark.createDataFrame([(1, [0], [1.0]), (2, [1], [2.0]), (3, [0, 9], [5.0, 1.0])], "doc_id long, pos array<int>, x array<double>")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0), (3, 0)], "doc_id long, y int")
    w = np.array([0.5, 1.0])
    r = CE.logistic_certificate(feats, labels, w).first()       # a row of a repeated id counts once for each row of that id
    loss, g = np.log1p(np.exp([0.5, 2.5])), 1 / (1 + np.exp([-0.5, -2.5])) - [1, 0]
    assert (r.rows, r.loss, r.gradient_norm) == pytest.approx((6, 4 * (loss[0] - 0.5) + loss[1], abs(4 * g[0] + 5 * g[1])))
    h = CE.hinge_certificate(feats, labels, w, 1.0).first()
    assert (h.rows, h.loss) == pytest.approx((6, (4 * 0.5 + 3.5) / 6 + 0.625))
