"""M18 by mini-batch SGD and M12's stop rule."""

import hashlib

import numpy as np
import pytest

from lodestar.operators import linear as LN


def _data(spark, n=80, size=9, parts=3):
    rng = np.random.default_rng(5)
    x = np.where(rng.random((n, size)) < 0.4, rng.random((n, size)), 0.0)
    y = (x[:, 0] + 0.3 * rng.random(n) > x[:, 1]).astype(int)
    feats = spark.createDataFrame([(i, int(p), float(x[i, p])) for i in range(n) for p in np.flatnonzero(x[i])], "doc_id long, pos int, x double")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, y int")
    return x, y, LN.SparseDesign.build(feats.repartition(parts), labels.repartition(parts), size)


def member(seed, t, key, fraction):
    return int(hashlib.md5(f"{seed}:{t}:{key}".encode()).hexdigest()[:8], 16) < int(fraction * 2 ** 32)


@pytest.mark.parametrize("fraction,reg", [(1.0, 0.0), (0.3, 0.01)])
def test_steps_are_the_stated_rule(spark, fraction, reg):
    x, y, design = _data(spark)
    w, trace = LN.train_svm_sgd(design, rate=0.7, fraction=fraction, reg=reg, max_iter=6, tol=0.0, seed=9)
    want, yp = np.zeros(9), 2 * y - 1
    for t in range(1, 7):
        rows = [i for i in range(len(y)) if fraction == 1 or member(9, t, i, fraction)]
        hit = np.array([yp[i] * (x[i] @ want) < 1 for i in rows])
        grad = -(x[rows] * (yp[rows] * hit)[:, None]).sum(axis=0) / len(rows)
        step = 0.7 / np.sqrt(t)
        want = want * (1 - step * reg) - step * grad
        assert trace.rows[t - 1][1] == len(rows)
    assert np.allclose(w, want)
    design.release()


def test_same_batches_under_other_partitions_and_empty_batches(spark):
    _, _, a = _data(spark, parts=1)
    _, _, b = _data(spark, parts=7)
    assert np.allclose(LN.train_svm_sgd(a, fraction=0.4, max_iter=4)[0], LN.train_svm_sgd(b, fraction=0.4, max_iter=4)[0])
    w, trace = LN.train_svm_sgd(a, fraction=1e-9, max_iter=3)
    assert not w.any() and trace.rows == []
    a.release(), b.release()


def test_run_lowers_the_loss_and_stops(spark):
    x, y, design = _data(spark)
    w, trace = LN.train_svm_sgd(design, max_iter=60, tol=0.02)
    assert trace.rows[-1][2] < 0.6 * trace.rows[0][2]
    assert len(trace.rows) < 60
    assert (((x @ w) > 0) == (y == 1)).mean() > 0.8
    design.release()
