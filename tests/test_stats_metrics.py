import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from lodestar.operators import metrics as MT
from lodestar.operators import stats as ST


def test_gd_on_sufficient_statistics_converges_to_ols(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, 200)
    y = 3.0 * x + 2.0 + rng.normal(0, 0.1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    ols = ST.ols_fit(df, "x", "y").first()
    stats = ST.gram_stats(df, ["x", 1.0], "y", ["m", "b"])
    trace = ST.gd_trace(stats, 0.1, 0.01, 5000, scale_by_n=True)
    _, loss0, _, m, b = trace[0]
    _, loss_last, _, m, b = trace[-1]
    assert loss_last < loss0
    assert math.isclose(m, ols.slope, rel_tol=1e-4) and math.isclose(b, ols.intercept, rel_tol=1e-3)


def test_gd_loss_matches_row_level_loss(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.5), (3.0, 7.0)], "x double, y double")
    stats = ST.gram_stats(df, ["x", 1.0], "y")
    _, loss, _, _, _ = ST.gd_trace(stats, 0.1, 1e-5, 1, scale_by_n=True)[0]
    assert math.isclose(loss, sum((yy - (0.1 * xx + 0.1)) ** 2 for xx, yy in [(1, 2), (2, 3.5), (3, 7)]))


def test_additive_step_rule(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    stats = ST.gram_stats(df, [1.0, "x"], "y")
    trace = ST.gd_trace(stats, 0.1, 1e-3, 3, scale_by_n=False, step_rule="additive", step_delta=1e-3)
    assert [round(t[2], 6) for t in trace] == [0.001, 0.002, 0.003]


def test_gram_matrix_matches_numpy(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(30, 4)).astype(np.float32)
    df = spark.createDataFrame([(row.tolist(),) for row in m], "v array<float>")
    g = {(r.i, r.j): r.g for r in ST.gram_matrix(df, "v").collect()}
    ref = m.astype(float).T @ m.astype(float)
    assert len(g) == 10
    for (i, j), v in g.items():
        assert math.isclose(v, ref[i, j], rel_tol=1e-9, abs_tol=1e-9)


def test_sparse_population_variance(spark):
    dense = np.array([[0.5, 0.0, 0.5], [0.0, 0.0, 1.0], [1.0, 0.0, 0.0], [0.2, 0.8, 0.0]])
    rows = [(d, p, float(v)) for d in range(4) for p, v in enumerate(dense[d]) if v != 0]
    feats = spark.createDataFrame(rows, "doc_id long, pos int, tf double")
    mom = {r.pos: (r.mean, r.variance) for r in ST.column_moments(feats, F.lit(4)).collect()}
    for p in range(3):
        assert math.isclose(mom[p][0], dense[:, p].mean())
        assert math.isclose(mom[p][1], dense[:, p].var())   # population variance
    top = ST.top_variance(ST.column_moments(feats, F.lit(4)), 2).collect()
    assert [r.pos for r in top] == list(np.argsort(-dense.var(axis=0), kind="stable")[:2])


def test_confusion_and_f1(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "label int, prediction int")
    r = MT.f1_from_confusion(MT.confusion(df)).first()
    assert (r.tp, r.tn, r.fn, r.fp) == (2, 1, 1, 1)
    assert math.isclose(r.f1, 2 * (2 / 3) * (2 / 3) / (4 / 3))
    none = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert MT.f1_from_confusion(MT.confusion(none)).first().f1 == 0.0


def test_auc_matches_pairwise_count_with_ties(spark):
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 5, 300).astype(float)
    labels = (rng.random(300) < 0.3 + 0.1 * scores).astype(int)
    df = spark.createDataFrame([(float(s), int(l)) for s, l in zip(scores, labels)], "score double, label int")
    got = MT.auc(df.repartition(5)).first().auc
    pos = scores[labels == 1]
    neg = scores[labels == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    assert math.isclose(got, wins / (len(pos) * len(neg)), rel_tol=1e-12)


def test_per_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    pc = {r.cls: (r.tp, r.fp, r.fn, r.support) for r in MT.per_class_metrics(df).collect()}
    assert pc == {0: (1, 0, 1, 2), 1: (1, 2, 0, 1), 2: (0, 0, 1, 1)}


def test_global_rank_matches_sorted_order(spark):
    from lodestar.operators.common import global_rank
    rng = np.random.default_rng(5)
    vals = [(f"w{i:04d}", int(rng.integers(0, 20))) for i in rng.permutation(500)]
    df = spark.createDataFrame(vals, "value string, n int")
    got = {r.value: r.idx for r in global_rank(df, [F.desc("n"), F.asc("value")], "idx").collect()}
    expected = sorted(vals, key=lambda t: (-t[1], t[0]))
    assert got == {v: i for i, (v, _) in enumerate(expected)}


def test_selection_keeps_documents_without_a_selected_position(spark):
    feats = spark.createDataFrame([(1, 0, 0.5), (1, 7, 0.5), (2, 7, 1.0)], "doc_id long, pos int, tf double")
    kept = ST.select_positions(feats, spark.createDataFrame([(0,)], "pos int"))
    got = {r.doc_id: (r.n, r.s) for r in kept.groupBy("doc_id").agg(F.count("pos").alias("n"), F.sum("tf").alias("s")).collect()}
    assert got == {1: (1, 0.5), 2: (0, None)}


def test_gram_matrix_with_nulls(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, None],), (None,), ([0.5, -1.0],)], "v array<double>")
    got = {(r.i, r.j): r.g for r in ST.gram_matrix(df.repartition(3), "v").collect()}
    assert got == {(0, 0): 10.25, (0, 1): 1.5, (1, 1): 5.0}


def test_hash_split_is_stable_under_repartitioning(spark):
    from lodestar.operators.tabular import hash_split
    df = spark.range(2000).withColumnRenamed("id", "k")
    _, test_a = hash_split(df.repartition(1), "k", 7)
    _, test_b = hash_split(df.repartition(13), "k", 7)
    a = {r.k for r in test_a.collect()}
    assert a == {r.k for r in test_b.collect()}
    assert 100 < len(a) < 300


def test_nearest_centroid_matches_numpy(spark):
    rng = np.random.default_rng(6)
    labels = rng.integers(0, 3, 90)
    x = (rng.normal(size=(90, 4)) + labels[:, None] * 2.0).astype(np.float32)
    df = spark.createDataFrame([(i, x[i].tolist(), int(labels[i])) for i in range(90)],
                               "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.prediction for r in MT.nearest_centroid(df, "embedding", "label", ["vec_id"]).collect()}
    xd = x.astype(float)
    mu = np.vstack([xd[labels == c].mean(axis=0) for c in range(3)])
    ref = np.argmax(xd @ mu.T - 0.5 * (mu * mu).sum(axis=1), axis=1)
    assert got == {i: int(ref[i]) for i in range(90)}


def test_nearest_centroid_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(MT, "CENTROID_BYTES", 64)       # every class in a block of its own
    df = spark.createDataFrame([(i, [float(i % 4), 1.0], i % 4) for i in range(20)], "vec_id long, embedding array<float>, label int")
    assert all(r.prediction == r.vec_id % 4 for r in MT.nearest_centroid(df, "embedding", "label", ["vec_id"]).collect())
