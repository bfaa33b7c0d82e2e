import math

import numpy as np
from pyspark.sql import functions as F

from lodestar.operators import linear as LN
from lodestar.operators import mixture as MX


def _design(spark, rows, labels, size):
    feats = spark.createDataFrame(rows, "doc_id long, pos int, x double")
    labs = spark.createDataFrame(labels, "doc_id long, y int")
    return LN.SparseDesign.build(feats, labs, size)


def test_two_class_margins_worked_example(spark):
    # one-hot documents so that the class scores are [[1,2],[3,4],[5,6],[7,8]]
    d = _design(spark, [(i, i, 1.0) for i in range(4)], [(0, 0), (1, 1), (2, 0), (3, 1)], 4)
    w = np.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]])
    loss, reg_loss, grad = LN.two_class_step(d, w, reg=0.0)
    assert loss == 1.0 and reg_loss == 0.0
    # coefficients [[-1,1],[0,0],[-1,1],[0,0]] averaged over 4 documents
    assert np.allclose(grad, np.array([[-1, 1], [0, 0], [-1, 1], [0, 0]]) / 4.0)
    d.release()


def test_logistic_first_step_with_constant_weights(spark):
    # TF rows sum to 1, so with constant weights c every theta equals c
    rows = [(0, 0, 0.5), (0, 1, 0.5), (1, 1, 1.0), (2, 0, 0.25), (2, 2, 0.75)]
    d = _design(spark, rows, [(0, 1), (1, 0), (2, 1)], 3)
    c = 0.01
    cost, grad = LN.logistic_step(d, np.full(3, c))
    ys = [1, 0, 1]
    assert math.isclose(cost, sum(-y * c + math.log1p(math.exp(c)) for y in ys))
    sig = 1 / (1 + math.exp(-c))
    assert math.isclose(grad[0], 0.5 * (sig - 1) + 0.25 * (sig - 1))
    assert math.isclose(grad[1], 0.5 * (sig - 1) + 1.0 * (sig - 0))
    d.release()


def test_logistic_training_lowers_cost_and_bold_driver(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for doc in range(60):
        y = int(doc % 2)
        p = [0, 1] if y else [2, 3]
        rows += [(doc, p[0], 0.5), (doc, p[1], 0.5)]
        labels.append((doc, y))
    d = _design(spark, rows, labels, 4)
    w, trace = LN.train_logistic(d, max_iter=8)
    costs = [r[1] for r in trace.rows]
    assert costs[-1] < costs[0]
    lrs = [r[2] for r in trace.rows]
    assert math.isclose(lrs[1], 0.01 * 1.05)      # first cost < +inf -> grow
    scores = LN.linear_scores(spark.createDataFrame(rows, "doc_id long, pos int, x double"), d.rows, w)
    pred = {r.doc_id: r.prediction for r in LN.predict_threshold(scores).collect()}
    assert all(pred[doc] == doc % 2 for doc in range(60))
    d.release()


def test_hinge_uses_plus_minus_one_labels(spark):
    d = _design(spark, [(0, 0, 1.0), (1, 0, 1.0)], [(0, 1), (1, 0)], 1)
    loss, grad = LN.hinge_step(d, np.array([0.5]), reg=0.0)
    # y'=+1: max(0, 1-0.5)=0.5 ; y'=-1: max(0, 1+0.5)=1.5 ; mean = 1.0
    assert math.isclose(loss, 1.0)
    # gradient: (-1*1 + 1*1) / 2 = 0
    assert math.isclose(grad[0], 0.0)
    d.release()


def _mixture_rows(spark):
    rows = []
    for doc in range(40):
        label = "a" if doc < 20 else "b"
        pos = [0, 1] if label == "a" else [2, 3]
        rows.append((f"{label}/{doc}", label, pos, [0.5, 0.5]))
    return spark.createDataFrame(rows, "doc_id string, label string, pos array<int>, x array<double>")


def test_mixture_posterior_sums_to_one_and_params_valid(spark):
    rows = _mixture_rows(spark)
    idx = MX.class_index(rows)
    r = rows.join(F.broadcast(idx), "label")
    log_pi, log_mu = MX.mle_params(r, "cls", 4)
    assert all(v.ok for v in MX.validate_params(log_pi, log_mu, 4).collect())
    post = MX.posterior_by_blocks(r, log_pi.join(log_mu, "cls"), 4, ["cls"]).collect()
    for p in post:
        assert math.isclose(sum(p.post), 1.0)
        assert p.post[p.cls] > 0.5


def test_gibbs_is_reproducible_under_repartitioning(spark):
    rows = _mixture_rows(spark)
    a = MX.gibbs(rows.repartition(1), 2, 4, iterations=3, seed=11)
    b = MX.gibbs(rows.repartition(5), 2, 4, iterations=3, seed=11)
    assert a.counts == b.counts
    assert np.allclose(a.mu, b.mu)
    assert sum(a.counts[-1]) == 40


def test_documents_without_features_are_zero_rows(spark):
    d = _design(spark, [(0, 0, 1.0)], [(0, 1), (1, 0)], 2)
    assert d.n_docs == 2
    loss, reg, grad = LN.two_class_step(d, np.full((2, 2), 0.1), reg=0.0)
    assert math.isclose(loss, 1.0)      # the empty row's margin is 1 too
    assert np.allclose(grad, [[0.5, -0.5], [0.0, 0.0]])
    scores = LN.linear_scores(spark.createDataFrame([(0, 0, 1.0)], "doc_id long, pos int, x double"), d.rows, np.array([-1.0, 0.0]))
    assert {r.doc_id: r.prediction for r in LN.predict_threshold(scores).collect()} == {0: 0, 1: 1}
    d.release()


def test_numpy_steps_equal_plain_sums(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(p), float(rng.random())) for i in range(50) for p in rng.choice(9, rng.integers(0, 5), replace=False)]
    y = {i: int(rng.integers(0, 2)) for i in range(50)}
    x = np.zeros((50, 9))
    for i, p, v in rows:
        x[i, p] = v
    d = _design(spark, rows, list(y.items()), 9)
    w, ys = rng.normal(size=9), np.array([y[i] for i in range(50)])
    cost, grad = LN.logistic_step(d, w)
    t = x @ w
    assert math.isclose(cost, (np.log1p(np.exp(t)) - ys * t).sum())
    assert np.allclose(grad, x.T @ (1 / (1 + np.exp(-t)) - ys))
    loss, grad = LN.hinge_step(d, w, 0.5)
    yp = 2 * ys - 1
    assert math.isclose(loss, 0.25 * w @ w + np.maximum(0, 1 - yp * t).mean())
    assert np.allclose(grad, 0.5 * w - (x * ((yp * t < 1) * yp)[:, None]).mean(axis=0))
    d.release()


def test_gibbs_keeps_most_clusters_in_use(spark):
    import __spark_entry__  # noqa: F401
    from lodestar.plans import mixture_plans as MP
    c = MP._Corpus(spark, "/root/testdata/sf0.01")
    res = MX.gibbs(c.rows.select("doc_id", "label", "pos", "x"), 20, MP.VOCAB, iterations=25)
    assert sum(n > 0 for n in res.counts[-1]) > 10
    sizes = {r.cluster: r["count"] for r in res.assigned.groupBy("cluster").count().collect()}
    assert sum(sizes.values()) == c.rows.count()


def test_cluster_sums(spark):
    rows = _mixture_rows(spark)
    assigned = rows.select("doc_id", F.when(F.col("label") == "a", 0).otherwise(1).alias("cluster"))
    got = {(r.cluster, r.pos): (r.n_docs, r.total) for r in MX.cluster_sizes(assigned, rows).collect()}
    assert got == {(0, 0): (20, 10.0), (0, 1): (20, 10.0), (1, 2): (20, 10.0), (1, 3): (20, 10.0)}


def test_column_and_array_forms_agree(spark):
    from lodestar.functions import numeric as N
    t = [-800.0, -1.5, 0.0, 2.0, 800.0]
    got = spark.createDataFrame([(v,) for v in t], "t double").select("t", N.sigmoid("t").alias("s"), N.softplus("t").alias("p"), N.hinge("t").alias("h")).collect()
    for r in got:
        x = np.array([r.t])
        assert math.isclose(r.s, LN.np_sigmoid(x)[0]) and math.isclose(r.p, LN.np_softplus(x)[0]) and r.h == max(0.0, r.t)
