"""Evaluation metrics (A17, A18, A25, A26, F13) as aggregates.

AUC is exact (Mann-Whitney with half credit for ties) without a global
single-partition rank: rows are first grouped by distinct score, the distinct
scores are range-partitioned (as many partitions as the data need), and the
number of negatives below each score is a prefix sum over the partition totals
plus a window inside each partition.  A score shared by a third of all rows is
one row after the first aggregation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """TP, TN, FN, FP in one aggregate."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 1)).alias("fp"))


def f1_from_confusion(conf: DataFrame) -> DataFrame:
    """Precision, recall and F1; all 0 when TP = 0."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    prec = F.when(tp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    rec = F.when(tp == 0, F.lit(0.0)).otherwise(tp / (tp + fn))
    f1 = F.when(tp == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return conf.select("*", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def per_class_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class TP/FP/FN, precision, recall, F1 and support.

    Each row adds to its true class (support, TP when right, FN when wrong)
    and to its predicted class (FP when wrong): two small rows per input row,
    combined per task before the shuffle."""
    y, p = F.col(label), F.col(pred)
    hit = (y == p).cast("long")
    entries = F.array(
        F.struct(y.alias("cls"), hit.alias("tp"), F.lit(0).cast("long").alias("fp"),
                 (1 - hit).alias("fn"), F.lit(1).cast("long").alias("support")),
        F.struct(p.alias("cls"), F.lit(0).cast("long").alias("tp"), (1 - hit).alias("fp"),
                 F.lit(0).cast("long").alias("fn"), F.lit(0).cast("long").alias("support")))
    agg = (df.select(F.explode(entries).alias("e")).groupBy(F.col("e.cls").alias("cls"))
           .agg(*[F.sum(f"e.{c}").alias(c) for c in ("tp", "fp", "fn", "support")]))
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    prec = F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    rec = F.when(tp + fn == 0, F.lit(0.0)).otherwise(tp / (tp + fn))
    f1 = F.when(prec + rec == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return agg.select("cls", "tp", "fp", "fn", "support", prec.alias("precision"),
                      rec.alias("recall"), f1.alias("f1"))


def overall_metrics(per_class: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    s = F.col("support").cast("double")
    total = F.sum(s)
    return per_class.agg((F.sum("tp") / total).alias("accuracy"),
                         (F.sum(s * F.col("precision")) / total).alias("weighted_precision"),
                         (F.sum(s * F.col("recall")) / total).alias("weighted_recall"),
                         (F.sum(s * F.col("f1")) / total).alias("weighted_f1"))


def auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, one row ``(auc, positives, negatives)``."""
    y = F.col(label).cast("int")
    per_score = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(y).cast("double").alias("pos"), F.sum(1 - y).cast("double").alias("neg"))
    # Persisted, so that the offsets and the windows see the same ranges.
    ranged = (per_score.repartitionByRange("s").withColumn("part", F.spark_partition_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    totals = ranged.groupBy("part").agg(F.sum("neg").alias("pneg"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("pneg").over(before), F.lit(0.0)).alias("off"))
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = (ranged.join(offsets, "part")
             .select("pos", "neg", (F.col("off") + F.coalesce(F.sum("neg").over(inside), F.lit(0.0))).alias("nb")))
    return below.agg(
        (F.sum(F.col("pos") * (F.col("nb") + 0.5 * F.col("neg"))) / (F.sum("pos") * F.sum("neg"))).alias("auc"),
        F.sum("pos").cast("long").alias("positives"), F.sum("neg").cast("long").alias("negatives"))


# Centroids are sent to the tasks in blocks of this many bytes.
CENTROID_BYTES = 8 << 20


def centroids(vectors: DataFrame, vec_col: str, label: str) -> DataFrame:
    """``(cls, i, mu)``: mean vector of every class.  Each task adds up its
    rows by class and hands on one vector per class."""
    kind = vectors.schema[label].dataType.simpleString()

    def partial(batches):
        sums, counts = {}, {}
        for pdf in batches:
            for cls, part in pdf.groupby(label, sort=False)[vec_col]:
                x = np.vstack([np.asarray(v, dtype=np.float32).astype(float) for v in part])
                sums[cls] = sums.get(cls, 0.0) + x.sum(axis=0)
                counts[cls] = counts.get(cls, 0) + len(x)
        for cls, s in sums.items():
            yield pd.DataFrame({"cls": cls, "i": np.arange(len(s)), "s": s, "n": counts[cls]})

    parts = vectors.select(label, vec_col).mapInPandas(partial, f"cls {kind}, i int, s double, n long")
    return parts.groupBy("cls", "i").agg((F.sum("s") / F.sum("n")).alias("mu"))


def nearest_centroid(vectors: DataFrame, vec_col: str, label: str, keep: list[str]) -> DataFrame:
    """F13 on a nearest-class-centroid rule: prediction = argmax_c
    x.mu_c - |mu_c|^2 / 2 (Euclidean), ties -> smaller class.

    The table is read once for the centroids and once for the scores.  The
    centroids go to the tasks in blocks of bounded bytes; every vector keeps
    its best class so far from block to block, in place: no explode, join or
    shuffle of the vectors."""
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType.simpleString()
    cent = centroids(vectors, vec_col, label).persist(StorageLevel.MEMORY_AND_DISK)
    blocks = max(1, -(-cent.count() * 16 // CENTROID_BYTES))
    kept = list(dict.fromkeys([*keep, vec_col]))
    out = vectors.select(*kept, F.lit(float("-inf")).alias("_best"), F.lit(None).cast(kind).alias("prediction"))
    schema = out.schema
    for b in range(blocks):
        pdf = cent.where(F.pmod(F.xxhash64("cls"), F.lit(blocks)) == b).toPandas()
        if len(pdf) == 0:
            continue
        wide = pdf.pivot(index="cls", columns="i", values="mu").sort_index().fillna(0.0)
        mu = wide.to_numpy()
        params = spark.sparkContext.broadcast((mu, 0.5 * (mu * mu).sum(axis=1), wide.index.to_numpy()))

        def score(batches, params=params):
            m, half, cls = params.value
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                x = np.vstack([np.asarray(v, dtype=np.float32).astype(float) for v in pdf[vec_col]])
                s = x @ m.T - half[None, :]
                at = s.argmax(axis=1)
                top, name, best = s[np.arange(len(s)), at], cls[at], pdf["_best"].to_numpy()
                old = pdf["prediction"].to_numpy()
                first = np.isneginf(best)
                better = first | (top > best)
                better[~better] = (top == best)[~better] & (name < old)[~better]
                yield pdf.assign(_best=np.where(better, top, best), prediction=np.where(better, name, old))

        out = out.mapInPandas(score, schema)
    return out.select(*keep, "prediction")
