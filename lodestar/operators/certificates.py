"""Optimality certificates of fitted linear models (M14, M18), by plain aggregates.

They know nothing of the optimiser: from the weights, the features and the labels
they recompute the loss and its (sub)gradient.  Both losses are convex, so the loss
exceeds that of any weights within distance r by at most ``gradient_norm * r``.

One pass gives both: a task reads its labelled rows and hands on its sums, at most one number
per position, so only one pair of arrays per document is shuffled, to its label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lodestar.operators import linear as LN

TOTALS = -1     # the place of a task's totals among its positions


def _rows(features: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, times, pos[], x[]) of every labelled row; one of m rows with the same id stands for ``times`` = m rows."""
    if not isinstance(features.schema["pos"].dataType, ArrayType):
        features = LN.doc_arrays(features.where("pos is not null and x is not null"))
    times = F.count(F.lit(1)).over(Window.partitionBy("doc_id")).cast("double")
    return (labels.where("doc_id is not null").select("doc_id", F.col("y").cast("double").alias("y"), times.alias("times"))
            .join(features.select("doc_id", "pos", "x"), "doc_id", "left").select("y", "times", "pos", "x"))


def _sums(rows: DataFrame, w: np.ndarray, terms, own, scale: float) -> DataFrame:
    """One row: ``rows, known`` (those with a label), sums ``loss`` and ``violated`` over the known ones, norm and largest part of
    the gradient ``own + scale * sum x k``, norm of its part without ``own``, and |w|^2.
    ``terms(theta, y)`` gives losses, factors k and violations of known rows from their scores and labels."""
    sent = rows.sparkSession.sparkContext.broadcast(np.asarray(w, float))

    def part(batches):
        weights = sent.value
        grad, total = np.zeros(len(weights)), np.zeros(4)
        for batch in batches:
            y, times = (batch.column(batch.schema.get_field_index(c)) for c in ("y", "times"))
            known, y, times = y.is_valid().to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False), times.to_numpy()
            for lo, hi, row, pos, x in LN.sparse_slices(batch):
                inside = (pos >= 0) & (pos < len(weights))
                row, pos, x = row[inside], pos[inside], x[inside]
                here, many = known[lo:hi], times[lo:hi]
                theta = np.bincount(row, x * weights[pos], minlength=hi - lo)
                loss, k, violated = np.zeros(hi - lo), np.zeros(hi - lo), np.zeros(hi - lo)
                loss[here], k[here], violated[here] = terms(theta[here], y[lo:hi][here])
                grad += np.bincount(pos, x * (k * many)[row], minlength=len(grad))
                total += [many.sum(), many[here].sum(), (loss * many).sum(), (violated * many).sum()]
        at = np.flatnonzero(grad)
        none = np.zeros(len(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, TOTALS), pa.int32()), pa.array(np.append(grad[at], 0.0)), *(pa.array(np.append(none, t)) for t in total)],
            names=["pos", "d", "rows", "known", "loss", "violated"])

    names = ("d", "rows", "known", "loss", "violated")
    sums = (rows.mapInArrow(part, "pos int, " + ", ".join(f"{c} double" for c in names))
            .groupBy("pos").agg(*[F.sum(c).alias(c) for c in names]))
    weights = LN.weight_table(rows.sparkSession, w).unionByName(rows.sparkSession.createDataFrame([(TOTALS, 0.0)], "pos int, w0 double"))
    data = F.lit(scale) * F.coalesce("d", F.lit(0.0))
    return (weights.join(sums, "pos", "left").withColumn("data", data).withColumn("g", own + F.col("data"))
            .agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names[1:]],
                 F.sqrt(F.sum(F.col("g") * F.col("g"))).alias("gradient_norm"), F.max(F.abs("g")).alias("gradient_max"),
                 F.sqrt(F.sum(F.col("data") * F.col("data"))).alias("data_norm"), F.sum(F.col("w0") * F.col("w0")).alias("ww"))
            .withColumn("rows", F.col("rows").cast("long")))


def logistic_certificate(features: DataFrame, labels: DataFrame, w: np.ndarray) -> DataFrame:
    """One row ``rows, loss, gradient_norm, gradient_max`` of the summed logistic loss without
    penalty at weights ``w``; features (doc_id, pos, x) or one row (doc_id, pos[], x[]) per document,
    labels (doc_id, y) with y in {0, 1}.
    A labelled row without features has score 0; no labelled row gives loss and gradient 0."""
    def terms(theta, y):
        return LN.np_softplus(theta) - y * theta, LN.np_sigmoid(theta) - y, 0.0

    found = _sums(_rows(features, labels), w, terms, F.lit(0.0), 1.0)
    return found.select("rows", "loss", "gradient_norm", "gradient_max")


def hinge_certificate(features: DataFrame, labels: DataFrame, w: np.ndarray, reg: float = 0.0) -> DataFrame:
    """One row ``rows, loss, gradient_norm, gradient_max, gap`` of reg/2 |w|^2 + mean hinge loss.

    The subgradient takes rows at the kink as satisfied.  ``gap`` bounds the distance of the loss from
    the optimum: with reg > 0 the duality gap at the point that the violated rows give; without a penalty the
    loss itself (no loss is below 0).  No labelled row: the loss is that of the penalty."""
    def terms(theta, y):
        yp = 2 * y - 1
        violated = yp * theta < 1
        return np.maximum(0.0, 1 - yp * theta), np.where(violated, -yp, 0.0), violated

    n = max(1, labels.count())
    found = _sums(_rows(features, labels), w, terms, F.lit(float(reg)) * F.col("w0"), 1.0 / n)
    mean = F.coalesce(F.try_divide("loss", "rows"), F.lit(0.0))
    found = found.withColumn("loss", mean + F.lit(reg / 2) * F.col("ww"))
    gap = F.col("loss")
    if reg > 0:
        # data_norm: |sum of the violated rows / n|, the part of the gradient without the penalty.
        dual = F.coalesce(F.try_divide("violated", "known"), F.lit(0.0))
        gap = gap - (dual - F.col("data_norm") * F.col("data_norm") / (2 * reg))
    return found.select("rows", "loss", "gradient_norm", "gradient_max", gap.alias("gap"))
