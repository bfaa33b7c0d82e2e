"""Iterative linear classifiers on sparse features (M10-M16, J8, A23, A24,
M11-M13).

Training data are one row per labelled document, ``(doc_id, y, pos[], x[])``
with the positions sorted, packed into Arrow blocks, written to the checkpoint
folder (lineage cut, survives lost executors) and cached; a document without
features is an all-zero row.  Each iteration is one Spark job:

* the weights (one per vocabulary position and class, a bound fixed by
  parameters) are broadcast once;
* every task scores its rows with numpy on blocks of bounded size, adds up loss
  and gradient, and hands on one dense row, so ``V`` numbers per task and class
  are added in a tree of tasks; the rows themselves never move.

Only the gradient (``V`` numbers per class) reaches the driver, where the step
and the step-size rule are applied -- the split MLlib uses.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir

def np_sigmoid(t: np.ndarray) -> np.ndarray:
    """F10 on arrays, without overflow."""
    e = np.exp(-np.abs(t))
    return np.where(t >= 0, 1.0, e) / (1.0 + e)


def np_softplus(t: np.ndarray) -> np.ndarray:
    """F10 on arrays: ln(1 + e^t) without overflow."""
    return np.maximum(t, 0.0) + np.log1p(np.exp(-np.abs(t)))


def stable(df: DataFrame) -> DataFrame:
    """Checkpoint to the configured checkpoint folder and cache."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)


def doc_arrays(features: DataFrame) -> DataFrame:
    """(doc_id, pos[], x[]) with ascending positions; a document holds at most
    one entry per vocabulary position, so each group is bounded by V."""
    e = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return (features.groupBy("doc_id").agg(e.alias("e"))
            .select("doc_id", F.col("e.pos").alias("pos"), F.col("e.x").alias("x")))


def packed(rows: DataFrame, *columns: str) -> DataFrame:
    """``(n int, block binary)``: the ``columns`` of the rows (with ``pos`` and ``x``) as Arrow streams of bounded
    size and their number of rows, so that a pass over cached rows hands bytes to the tasks and converts nothing."""
    def pack(batches):
        for batch in batches:
            for lo, hi, *_ in sparse_slices(batch):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema) as stream:
                    stream.write_batch(batch.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([hi - lo], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                                 names=["n", "block"])

    return rows.select(*columns).mapInArrow(pack, "n int, block binary")


def unpacked(batches):
    """The Arrow batches that ``packed`` put into the column ``block``."""
    for batch in batches:
        for block in batch.column(batch.schema.get_field_index("block")):
            yield from pa.ipc.open_stream(block.as_buffer())


@dataclass
class SparseDesign:
    rows: DataFrame          # doc_id, y, pos[], x[]
    blocks: DataFrame        # the same packed, doc_id as text, cached
    size: int                # number of positions (weights per class)
    n_docs: int
    parts: int               # partitions of ``blocks``

    @staticmethod
    def build(features: DataFrame, labels: DataFrame, size: int) -> "SparseDesign":
        """``features`` (doc_id, pos, x), null positions count for nothing;
        ``labels`` (doc_id, y) of every training document."""
        return SparseDesign.of(doc_arrays(features.where("pos is not null")), labels, size)

    @staticmethod
    def of(arrays: DataFrame, labels: DataFrame, size: int) -> "SparseDesign":
        """As ``build``, from one row ``(doc_id, pos[], x[])`` per document."""
        none = F.array()
        rows = (labels.select("doc_id", F.col("y").cast("double").alias("y"))
                .join(arrays, "doc_id", "left")
                .select("doc_id", "y", F.coalesce("pos", none.cast("array<int>")).alias("pos"),
                        F.coalesce("x", none.cast("array<double>")).alias("x")))
        blocks = stable(packed(rows.withColumn("doc_id", F.col("doc_id").cast("string")), "doc_id", "y", "pos", "x"))
        n = blocks.select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return SparseDesign(rows, blocks, size, n, blocks.rdd.getNumPartitions())

    def release(self) -> None:
        self.blocks.unpersist()


def renumbered(arrays: DataFrame, at: np.ndarray) -> DataFrame:
    """``arrays`` (doc_id, pos[], x[]) with position p as ``at[p]``, again ascending; entries whose
    ``at[p]`` is below 0 drop out, their documents stay."""
    sent = arrays.sparkSession.sparkContext.broadcast(np.asarray(at, np.int64))

    def part(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("doc_id"))
            for lo, hi, row, pos, x in sparse_slices(batch):
                new = sent.value[pos]
                kept = new >= 0
                row, new, x = row[kept], new[kept], x[kept]
                order = np.lexsort((new, row))
                ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, hi - lo), pa.ListArray.from_arrays(ends, pa.array(new[order], pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(x[order]))], names=["doc_id", "pos", "x"])

    kind = arrays.schema["doc_id"].dataType.simpleString()
    return arrays.select("doc_id", "pos", "x").mapInArrow(part, f"doc_id {kind}, pos array<int>, x array<double>")


def weight_table(spark: SparkSession, w: np.ndarray) -> DataFrame:
    """(pos, w0[, w1 ...]) from a (V,) or (V, C) parameter array."""
    w2 = w.reshape(len(w), -1)
    pdf = pd.DataFrame({"pos": np.arange(len(w2), dtype=np.int32)})
    for c in range(w2.shape[1]):
        pdf[f"w{c}"] = w2[:, c].astype(float)
    return spark.createDataFrame(pdf)


SLICE_ENTRIES = 500_000     # non-zero entries that a task works on at once


def sparse_slices(batch, most: int | None = None):
    """``(first row, last row, row of each entry, pos, x)`` of an Arrow batch
    with list columns ``pos`` and ``x``, cut by the number of entries (``most``, or SLICE_ENTRIES)."""
    at, xs = (batch.column(batch.schema.get_field_index(c)) for c in ("pos", "x"))
    ends = np.concatenate(([0], np.cumsum(at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    pos = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    x = xs.flatten().to_numpy(zero_copy_only=False).astype(float)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (most or SLICE_ENTRIES), "right")) - 1)
        hi = min(hi, len(at))
        part = slice(ends[lo], ends[hi])
        yield lo, hi, np.repeat(np.arange(hi - lo), np.diff(ends[lo: hi + 1])), pos[part], x[part]
        lo = hi


TREE = 16                   # partial sums that one task, or the driver, adds up


def _step(design: SparseDesign, w: np.ndarray, coefs, loss, batch=None) -> tuple[float, np.ndarray, int]:
    """One pass: loss sum, gradient (V, C) and number of rows.  ``coefs(s, y)`` gives the
    factors of each class's gradient and ``loss(s, y)`` the losses, from the
    list of score arrays and the labels; ``batch`` (a function of the ids) picks the rows.

    Every task hands on one dense row; these are added TREE at a time until at most TREE are left."""
    wide = np.ascontiguousarray(w.reshape(design.size, -1).T, dtype=float)
    sent = design.blocks.sparkSession.sparkContext.broadcast(wide)
    classes = len(wide)
    schema = "node int, loss double, n long, grad binary"

    def row_of(node, total, seen, grad):
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([total], pa.float64()), pa.array([seen], pa.int64()),
                                           pa.array([grad.tobytes()], pa.binary())], names=["node", "loss", "n", "grad"])

    def part(batches):
        from pyspark import TaskContext
        weights, total, seen = sent.value, 0.0, 0
        grad = np.zeros(weights.shape)
        for rows in unpacked(batches):
            if batch is not None:
                rows = rows.filter(pa.array(batch(rows.column(0).to_pylist()), pa.bool_()))
            labels = rows.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, row, pos, x in sparse_slices(rows):
                y = labels[lo:hi]
                s = [np.bincount(row, x * weights[c][pos], minlength=hi - lo) for c in range(classes)]
                total += loss(s, y).sum()
                seen += hi - lo
                for c, k in enumerate(coefs(s, y)):
                    grad[c] += np.bincount(pos, x * k[row], minlength=grad.shape[1])
        if seen:
            yield row_of(TaskContext.get().partitionId() // TREE, total, seen, grad)

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(g.as_buffer()) for g in table.column("grad")], axis=0)
        return pa.Table.from_batches([row_of(table.column("node")[0].as_py() // TREE, sum(table.column("loss").to_pylist()),
                                             sum(table.column("n").to_pylist()), total)])

    sums, parts = design.blocks.select("block").mapInArrow(part, schema), design.parts
    while parts > TREE:
        sums = sums.groupBy("node").applyInArrow(add, schema)
        parts = -(-parts // TREE)
    got = sums.toArrow()
    sent.destroy()
    grad = np.zeros((classes, design.size))
    for g in got.column("grad"):
        grad += np.frombuffer(g.as_buffer()).reshape(grad.shape)
    return float(sum(got.column("loss").to_pylist())), grad.T, int(sum(got.column("n").to_pylist()))


def logistic_step(design: SparseDesign, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Cost sum(-y t + ln(1 + e^t)) and gradient sum x (sigma(t) - y)."""
    loss, grad, _ = _step(design, w, lambda s, y: [np_sigmoid(s[0]) - y], lambda s, y: -y * s[0] + np_softplus(s[0]))
    return loss, grad[:, 0]


def hinge_step(design: SparseDesign, w: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """0.5 reg w.w + mean max(0, 1 - y' t); gradient reg w + mean(-y' x [y' t < 1]),
    labels y' = 2y - 1."""
    def coefs(s, y):
        yp = 2 * y - 1
        return [np.where(yp * s[0] < 1, -yp, 0.0)]

    loss, grad, _ = _step(design, w, coefs, lambda s, y: np.maximum(0.0, 1 - (2 * y - 1) * s[0]))
    n = float(design.n_docs)
    return 0.5 * reg * float(w @ w) + loss / n, reg * w + grad[:, 0] / n


def two_class_step(design: SparseDesign, w: np.ndarray, reg: float) -> tuple[float, float, np.ndarray]:
    """One score per class; margin max(0, s_other - s_true + 1).  Returns
    (mean data loss, regulariser 0.5 reg |W|^2, gradient (V, 2)) where the
    gradient is mean(b x (+1 other, -1 true)) + reg W."""
    def margin(s, y):
        return np.maximum(0.0, np.where(y == 1, s[0] - s[1], s[1] - s[0]) + 1)

    def coefs(s, y):
        b = (margin(s, y) > 0).astype(float)
        return [np.where(y == 0, -b, b), np.where(y == 1, -b, b)]

    loss, grad, _ = _step(design, w, coefs, margin)
    n = float(design.n_docs)
    return loss / n, 0.5 * reg * float(np.sum(w * w)), grad / n + reg * w


@dataclass
class Trace:
    rows: list = field(default_factory=list)

    def frame(self, spark: SparkSession, names: list[str]) -> DataFrame:
        schema = ", ".join(["iteration int"] + [f"{n} double" for n in names])
        return spark.createDataFrame(self.rows, schema)


def bold_driver(lr: float, loss: float, prev: float, up: float = 1.05, down: float = 0.5) -> float:
    """Grow the rate after a falling loss, halve it otherwise."""
    return lr * up if loss < prev else lr * down


def train_logistic(design: SparseDesign, lr: float = 0.01, w0: float = 0.01,
                   max_iter: int = 100, tol: float = 1e-8) -> tuple[np.ndarray, Trace]:
    """Full-batch gradient descent, bold driver after the step, stop
    after ``max_iter`` steps or when |w_new - w| <= tol."""
    w = np.full(design.size, float(w0))
    prev, step, it, trace = float("inf"), float("inf"), 0, Trace()
    while it < max_iter and step > tol:
        cost, grad = logistic_step(design, w)
        new = w - lr * grad
        trace.rows.append((it, cost, lr, float(np.linalg.norm(new - w))))
        lr = bold_driver(lr, cost, prev)
        step = float(np.linalg.norm(new - w))
        w, prev, it = new, cost, it + 1
    return w, trace


def train_hinge(design: SparseDesign, lr: float = 0.01, w0: float = 1.5, reg: float = 1.0,
                max_iter: int = 100) -> tuple[np.ndarray, Trace]:
    """Binary hinge-loss SVM by gradient descent with the bold driver."""
    w = np.full(design.size, float(w0))
    prev, trace = float("inf"), Trace()
    for it in range(max_iter):
        loss, grad = hinge_step(design, w, reg)
        w = w - lr * grad
        trace.rows.append((it, loss, lr))
        lr = bold_driver(lr, loss, prev)
        prev = loss
    return w, trace


def train_two_class(design: SparseDesign, lr: float = 0.01, w0: float = 0.1, reg: float = 0.1,
                    max_iter: int = 100) -> tuple[np.ndarray, Trace]:
    """Two-column multiclass hinge SVM; the bold driver follows the data
    loss (as reported), the regulariser is reported next to it."""
    w = np.full((design.size, 2), float(w0))
    prev, trace = float("inf"), Trace()
    for it in range(max_iter):
        loss, reg_loss, grad = two_class_step(design, w, reg)
        w = w - lr * grad
        trace.rows.append((it, loss, reg_loss, lr))
        lr = bold_driver(lr, loss, prev)
        prev = loss
    return w, trace


def in_batch(seed: int, step: int, fraction: float):
    """Membership of rows in the mini-batch of a step, from their ids: the first 32 bits of
    md5("seed:step:id") below ``fraction`` of their range, the same under any partitioning."""
    def member(keys: list) -> list[bool]:
        most = int(fraction * 2 ** 32)
        return [int(hashlib.md5(f"{seed}:{step}:{k}".encode()).hexdigest()[:8], 16) < most for k in keys]

    return member


def train_svm_sgd(design: SparseDesign, rate: float = 1.0, fraction: float = 1.0, reg: float = 0.0, max_iter: int = 100,
                  tol: float = 0.001, seed: int = 42) -> tuple[np.ndarray, Trace]:
    """M18 by mini-batch SGD: hinge loss on +-1 labels, no intercept, weights from 0; step t takes the
    rows of its seeded batch and moves by ``rate / sqrt(t)`` times their mean gradient, after
    shrinking the weights by that step times ``reg``.  A batch without rows changes nothing; it stops
    when the weights move by less than ``tol`` of their norm (or of 1).  The trace holds
    (step, rows, mean loss, rate)."""
    w, trace = np.zeros(design.size), Trace()
    for t in range(1, max_iter + 1):
        loss, grad, n = _step(design, w, lambda s, y: [np.where((2 * y - 1) * s[0] < 1, 1 - 2 * y, 0.0)],
                              lambda s, y: np.maximum(0.0, 1 - (2 * y - 1) * s[0]),
                              in_batch(seed, t, fraction) if fraction < 1 else None)
        if not n:
            continue
        now = rate / np.sqrt(t)
        new = w * (1 - now * reg) - now * grad[:, 0] / n
        trace.rows.append((t, float(n), loss / n, float(now)))
        moved, w = np.linalg.norm(new - w), new
        if moved < tol * max(np.linalg.norm(w), 1.0):
            break
    return w, trace


def linear_scores(features: DataFrame, docs: DataFrame, w: np.ndarray) -> DataFrame:
    """J8 for scoring: (doc_id, s0[, s1]) = sum x * w per document of
    ``docs`` (doc_id), from long features; a document without features scores 0."""
    wt = weight_table(features.sparkSession, w)
    k = len(wt.columns) - 1
    sums = (features.join(F.broadcast(wt), "pos").groupBy("doc_id")
            .agg(*[F.sum(F.col("x") * F.col(f"w{c}")).alias(f"s{c}") for c in range(k)]))
    return docs.select("doc_id").join(sums, "doc_id", "left").fillna(0.0, [f"s{c}" for c in range(k)])


def predict_threshold(scores: DataFrame) -> DataFrame:
    """Prediction 1 when the score is >= 0."""
    return scores.select("doc_id", F.when(F.col("s0") >= 0, 1).otherwise(0).alias("prediction"))


def predict_positive(scores: DataFrame) -> DataFrame:
    """Prediction 1 when the margin is above 0."""
    return scores.select("doc_id", F.when(F.col("s0") > 0, 1).otherwise(0).alias("prediction"))


def predict_argmax2(scores: DataFrame) -> DataFrame:
    """F13 for two columns: class 1 only when its score is strictly larger."""
    return scores.select("doc_id", F.when(F.col("s1") > F.col("s0"), 1).otherwise(0).alias("prediction"))
