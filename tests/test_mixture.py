"""Class blocks, tree sums and the raising check of the mixture."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import mixture as MX

V, C = 30, 7


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(8)
    data = []
    for i in range(200):
        pos = sorted(rnd.sample(range(V), rnd.randint(0, 12)))
        data.append((f"s{i % 5}/{i}", i % C, pos, [rnd.random() for _ in pos]))
    return spark.createDataFrame(data, "doc_id string, cls int, pos array<int>, x array<double>").repartition(4)


@pytest.fixture(scope="module")
def params(rows):
    log_pi, log_mu = MX.mle_params(rows, "cls", V)
    return log_pi.join(log_mu, "cls")


def arrays(params):
    got = sorted(params.collect())
    return np.array([r.log_pi for r in got]), np.array([r.log_mu for r in got])


@pytest.mark.parametrize("block_bytes", [1, 8 * V * 3, 1 << 20])
def test_class_blocks_give_the_whole_posterior(rows, params, block_bytes):
    got = {r.doc_id: r.post for r in MX.posterior_by_blocks(rows, params, V, ["doc_id"], block_bytes).collect()}
    log_pi, log_mu = arrays(params)
    for r in rows.collect():
        lp = log_pi + sum((x * log_mu[:, p] for p, x in zip(r.pos, r.x, strict=True)), np.zeros(C))
        want = np.exp(lp - lp.max())
        assert np.allclose(got[r.doc_id], want / want.sum(), atol=1e-12)


def test_no_class(rows, params):
    assert {tuple(r.post) for r in MX.posterior_by_blocks(rows, params.where("false"), V, ["doc_id"]).collect()} == {()}


def test_uniform_is_the_stated_digest(spark):
    got = spark.range(20).select("id", MX.hash_uniform(5, 3, "id").alias("u")).collect()
    for r in got:
        assert r.u == MX.uniform(5, 3, str(r.id)) == int(hashlib.md5(f"5:3:{r.id}".encode()).hexdigest()[:13], 16) / 2 ** 52
    assert 0.2 < np.mean([r.u for r in got]) < 0.8


@pytest.mark.parametrize("parts", [1, 40])
def test_tree_sums_follow_the_draws(rows, params, parts):
    log_pi, log_mu = arrays(params)
    sums, _ = MX.sweep_sums(MX.packed(rows.repartition(parts)), 2, 0, log_pi, log_mu, parts)
    got = {}
    for r in sums.collect():
        n, total = got.get(r.cls, (0, 0))
        got[r.cls] = n + r.n, total + np.frombuffer(r.sums)
    assert all(sum(1 for r in sums.collect() if r.cls == c) <= MX.TREE for c in got)
    post = MX.posterior_by_blocks(rows, params, V, ["doc_id", "pos", "x"]).withColumn("u", MX.hash_uniform(2, 0, "doc_id"))
    n, total = np.zeros(C), np.zeros((C, V))
    for r in post.select("pos", "x", MX.drawn_class("post", "u").alias("c")).collect():
        n[r.c] += 1
        total[r.c, r.pos] += r.x
    assert sum(k for k, _ in got.values()) == 200
    for c in range(C):
        assert got.get(c, (0, 0))[0] == n[c] and np.allclose(got.get(c, (0, np.zeros(V)))[1], total[c])


def test_scores_are_the_plain_sums(monkeypatch):
    """Rows in parts, empty rows and rows longer than what is laid out at a time."""
    rng = np.random.default_rng(4)
    sizes = np.array([0, 3, 900, 0, 1, 40, 5000, 0])
    pos, x = rng.integers(0, V, sizes.sum()), rng.random(sizes.sum())
    words, log_pi = np.log(rng.dirichlet(np.ones(V), C)).T.copy(), np.log(rng.dirichlet(np.ones(C)))
    row = np.repeat(np.arange(len(sizes)), sizes)
    want = log_pi + np.array([(x[row == k, None] * words[pos[row == k]]).sum(axis=0) for k in range(len(sizes))])
    for cells, product in ((1 << 16, 1 << 13), (C * 50, C * 7), (1, 1)):
        monkeypatch.setattr(MX, "CELLS", cells), monkeypatch.setattr(MX, "PRODUCT", product)
        assert np.allclose(MX._log_scores(sizes, pos, x, log_pi, words), want, rtol=1e-12)
    with pytest.raises(IndexError):
        MX._log_scores(np.array([1]), np.array([V]), np.array([1.0]), log_pi, words)


def test_packed_rows_come_back(spark, rows):
    import pyarrow as pa
    ids = [("a", 1, [2, 70_000], [0.5, -0.25]), (None, 2, [], []), ("é", None, [0], [1.0])]
    df = spark.createDataFrame(ids, "doc_id string, label int, pos array<int>, x array<double>").coalesce(1)
    got = []
    for part in MX.LN.unpacked([pa.RecordBatch.from_arrays([pa.array([bytes(r.block) for r in MX.packed(df).collect()])], names=["block"])]):
        sizes, pos, x = MX._entries(part)
        ends = np.cumsum(sizes)
        got += [(d, label, pos[e - n: e].tolist(), x[e - n: e].tolist()) for d, label, n, e in
                zip(part.column(0).to_pylist(), part.column(1).to_pylist(), sizes, ends, strict=True)]
        assert MX.uniforms(3, 9, part.column(0)).tolist() == [MX.uniform(3, 9, str(d)) for d in part.column(0).to_pylist()]
    assert got == ids
    # An entry of a term frequency takes few bytes: no 8 for its value, no 4 for its position.
    many = spark.createDataFrame([(str(k), list(range(500)), [1 / 500] * 500) for k in range(200)], "doc_id string, pos array<int>, x array<double>")
    assert sum(len(r.block) for r in MX.packed(many.coalesce(1)).collect()) < 6 * 200 * 500


def test_wrong_parameters_fail_the_job_by_class(spark, params):
    log_pi = params.select("cls", "log_pi")
    assert MX.require_valid(MX.validate_params(log_pi, params.select("cls", "log_mu"), V)).count() == C
    bad = params.select("cls", F.when(F.col("cls") == 3, F.transform("log_mu", lambda v: v + 1)).otherwise(F.col("log_mu")).alias("log_mu"))
    with pytest.raises(Exception, match="class 3 with sum 2.7"):
        MX.require_valid(MX.validate_params(log_pi, bad, V)).count()


def test_no_document_moves_to_its_label(spark, tmp_path):
    from lodestar.plans import mixture_plans as MP
    docs = [(i, f"s{i % 3}" if i % 10 else None, f"one two w{i % 7}") for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = MP._Corpus(spark, str(tmp_path))
    plan = c.rows._jdf.queryExecution().executedPlan().toString()
    documents = plan[:plan.index("BroadcastExchange")]      # the side that stays
    assert "pos#" in documents and "FileScan" in documents and "Exchange " not in documents and "SortMergeJoin" not in documents, plan
    assert c.rows.storageLevel.useMemory is False
    rows = {r.doc_id: (r.label, r.cls, sum(r.x)) for r in c.rows.collect()}
    assert len(rows) == 54 and all(k.startswith(label + "/") and s == pytest.approx(1) for k, (label, _, s) in rows.items())
    assert len({(label, cls) for label, cls, _ in rows.values()}) == 3
