"""What grows with the input: rows shuffled by the text features, the Gram matrix and the optimisers' steps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import linear as LN
from lodestar.operators import mixture as MX
from lodestar.operators import stats as ST
from lodestar.operators import textfeatures as TF
from lodestar.sources import readers


def test_counts_are_read_not_grouped(spark):
    docs = spark.createDataFrame([(k, f"one two two w{k % 7}") for k in range(50)], "doc_id long, text string")
    f = TF.TextFeatures(docs, 20)
    for frame in (f.counts, f.rows, f.docs):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Exchange" not in plan, plan


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "a b K K"), (None, "a c"), (2, "x 1"), (1, "b B b"), (None, "C"), (3, None), (4, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    f = TF.TextFeatures(docs, 4)
    pos = dict(zip(f.words, range(4), strict=True))
    assert f.words == ["b", "a", "c", "k"]      # no Kelvin sign becomes a k
    got = {(r.doc_id, r.pos): (r.n, r.tf) for r in f.counts.collect()}
    assert got == {(1, pos["b"]): (4, 4 / 7), (1, pos["a"]): (1, 1 / 7), (1, pos["k"]): (2, 2 / 7),
                   (None, pos["a"]): (1, 1 / 3), (None, pos["c"]): (2, 2 / 3)}
    assert sorted((r.doc_id or 0, sorted(r.positions)) for r in f.docs.collect()) == [(0, [1, 2, 2]), (1, [0, 0, 0, 0, 1, 3, 3])]
    assert TF.TextFeatures(docs.limit(0), 4).counts.collect() == []


@pytest.mark.parametrize("tile_cells", [1, 100, 1000, 1 << 20])
def test_gram_tiles_are_the_dense_product(spark, tile_cells):
    rng = np.random.default_rng(5)
    size, rows = 40, []
    for _ in range(300):
        p = np.sort(rng.choice(size, rng.integers(0, 20), replace=False))
        rows.append((p.tolist(), rng.integers(-2, 3, len(p)).astype(float).tolist()))
    df = spark.createDataFrame(rows, "pos array<int>, x array<double>").repartition(3)
    got = {(r.i, r.j): r.g for r in ST.gram_blocks(df, size, 6, tile_cells).collect()}
    x = np.zeros((len(rows), size))
    for k, (p, v) in enumerate(rows):
        x[k, p] = v
    together = (x != 0).astype(int).T @ (x != 0)
    assert got == {(i, j): (x.T @ x)[i, j] for i in range(size) for j in range(i, size) if together[i, j]}


@pytest.mark.parametrize("parts", [1, 40])
def test_steps_hand_on_one_row_a_task(spark, parts):
    rng = np.random.default_rng(3)
    x, y = rng.random((60, 5)), rng.integers(0, 2, 60)
    feats = spark.createDataFrame([(d, p, float(x[d, p])) for d in range(60) for p in range(5)], "doc_id long, pos int, x double")
    labels = spark.createDataFrame([(d, int(y[d])) for d in range(60)], "doc_id long, y int")
    d = LN.SparseDesign.build(feats, labels, 5)
    d.blocks, d.parts = LN.packed(d.rows.withColumn("doc_id", d.rows.doc_id.cast("string")).repartition(parts), "doc_id", "y", "pos", "x"), parts
    w = np.linspace(-1, 1, 5)
    cost, grad = LN.logistic_step(d, w)
    theta = x @ w
    assert math.isclose(cost, float(np.sum(-y * theta + np.log1p(np.exp(theta)))))
    assert np.allclose(grad, x.T @ (1 / (1 + np.exp(-theta)) - y))
    d.release()


def test_renumbered_positions_ascend(spark):
    df = spark.createDataFrame([(1, [0, 2, 3], [1.0, 2.0, 3.0]), (2, [1], [4.0])], "doc_id long, pos array<int>, x array<double>")
    got = {r.doc_id: (r.pos, r.x) for r in LN.renumbered(df, np.array([1, -1, 2, 0])).collect()}
    assert got == {1: ([0, 1, 2], [3.0, 1.0, 2.0]), 2: ([], [])}


def test_sampler_tasks_follow_the_data(spark):
    """Each task hands on one model's worth of sums, so few documents in many partitions are few tasks."""
    parts = spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame([(f"a/{k}", [k % 3], [1.0]) for k in range(30)], "doc_id string, pos array<int>, x array<double>")
    res = MX.gibbs(rows.repartition(4 * parts), 2, 3, iterations=2, seed=1)
    assert res.data.rdd.getNumPartitions() == parts and sum(res.counts[-1]) == 30


def test_inference_guards_keep_every_value(spark):
    ints = ["1", "-1", "+5", " 7 ", "\t8\n", "0", "12345678901", "007"]
    bools = ["t", "TRUE", " y", "Yes ", "1", "f", "False", "n\n", "NO", "0"]
    others = ["1996-03-13", "1996-03-13T00:00:00.000Z", "12:30", "17.0", "A", "R", "", "truth", "- 1"]
    df = spark.createDataFrame([(v,) for v in ints + bools + others], "v string")
    for t, values in (("int", ints), ("bigint", ints), ("boolean", bools)):
        rows = df.select("v", F.col("v").rlike(readers._LIKE[t]).alias("may"), F.col("v").try_cast(t).isNotNull().alias("reads")).collect()
        assert all(r.may for r in rows if r.reads) and sum(r.reads for r in rows) >= len(values) - 1
        assert not [r.v for r in rows if r.may and r.v in others and r.v != "- 1"]
    assert readers.inferred_types(df.select("v", F.lit("1").alias("w"), F.lit("no").alias("b"))) == {"v": "string", "w": "int", "b": "boolean"}


def test_long_and_split_documents_are_counted_whole(spark, monkeypatch):
    """Texts counted in chunks, and ids going on over batches, give one row of all their words."""
    import pandas as pd
    docs = pd.DataFrame({"doc_id": [7, 8, 7, 9, 7, None], "text": ["a b " * 600_000, "c", "b", "zz", "a", "c c"]}).astype({"doc_id": "Int64"})
    df = spark.createDataFrame(docs.to_dict("records"), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.pos, r.n, r.total) for r in TF.encoded(df, ["a", "b", "c"]).collect()}
    assert got == {7: ([0, 1], [600_001, 600_001], 1_200_002), 8: ([2], [1], 1), None: ([2], [2], 2)}


def test_merged_rows_pass_unless_an_id_repeats():
    def batch(ids, pos, n):
        return TF._arrays(ids, TF.pa.int64(), [np.array(p, np.int32) for p in pos], [np.array(k, np.int64) for k in n])

    inside = [batch([None, 1], [[0], [1, 2]], [[1], [1, 1]]), batch([1, 2, 2], [[2], [0], [0]], [[5], [1], [2]]),
              batch([3, 4], [[0], [1]], [[1], [1]]), batch([], [], []), batch([5], [[3]], [[1]]), batch([5], [[3]], [[1]])]
    rows = [tuple(r.values()) for b in TF._merged(iter(inside)) for r in b.to_pylist()]
    assert rows == [(None, [0], [1]), (1, [1, 2], [1, 6]), (2, [0], [3]), (3, [0], [1]), (4, [1], [1]), (5, [3], [2])]
