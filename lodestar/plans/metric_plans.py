"""Registered metric queries: nearest-centroid classification of
``embeddings`` (F13, A17, A18, A26) and the AUC of document length for the
``labels.quality`` flag (A25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.numeric import significant
from lodestar.operators import metrics as MT
from lodestar.plans.registry import register
from lodestar.plans.sqlparts import sig
from lodestar.sources.tables import table

SIG = 8

CENTROID_SQL = """
WITH e AS (SELECT vec_id, label, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
c AS (SELECT label AS cls, i, avg(x) AS mu FROM e GROUP BY label, i),
h AS (SELECT cls, 0.5 * sum(mu * mu) AS half FROM c GROUP BY cls),
sc AS (SELECT e.vec_id, e.label, c.cls, sum(e.x * c.mu) - h.half AS score
       FROM e JOIN c USING (i) JOIN h ON h.cls = c.cls GROUP BY e.vec_id, e.label, c.cls, h.half),
pr AS (SELECT vec_id, label, cls AS prediction FROM
       (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls) AS rn FROM sc) WHERE rn = 1)"""

PER_CLASS_SQL = CENTROID_SQL + """,
ent AS (SELECT label AS cls, CAST(label = prediction AS BIGINT) AS tp, 0 AS fp, CAST(label <> prediction AS BIGINT) AS fn, 1 AS support FROM pr
        UNION ALL SELECT prediction, 0, CAST(label <> prediction AS BIGINT), 0, 0 FROM pr),
pc AS (SELECT cls, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
              CAST(sum(support) AS BIGINT) AS support FROM ent GROUP BY cls),
pm AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pm)"""


def _centroid_predictions(spark, sf):
    """Nearest class centroid by Euclidean distance: argmax x.mu_c - |mu_c|^2/2."""
    emb = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    return MT.nearest_centroid(emb, "embedding", "label", ["vec_id", "label"])


@register("centroid_class_metrics", sql=PER_CLASS_SQL + f"""
SELECT cls, tp, fp, fn, support, {sig('precision')} AS precision, {sig('recall')} AS recall, {sig('f1')} AS f1 FROM pf
""")
def centroid_class_metrics(spark, sf):
    pc = MT.per_class_metrics(_centroid_predictions(spark, sf))
    return pc.select("cls", "tp", "fp", "fn", "support",
                     *[significant(c, SIG).alias(c) for c in ("precision", "recall", "f1")])


@register("centroid_overall_metrics", sql=PER_CLASS_SQL + f"""
SELECT {sig('sum(tp) / sum(support)')} AS accuracy,
       {sig('sum(support * precision) / sum(support)')} AS weighted_precision,
       {sig('sum(support * recall) / sum(support)')} AS weighted_recall,
       {sig('sum(support * f1) / sum(support)')} AS weighted_f1 FROM pf
""")
def centroid_overall_metrics(spark, sf):
    o = MT.overall_metrics(MT.per_class_metrics(_centroid_predictions(spark, sf)))
    return o.select(*[significant(c, SIG).alias(c) for c in o.columns])


@register("centroid_binary_f1", sql=CENTROID_SQL + f""",
b AS (SELECT CAST(label = 0 AS INTEGER) AS y, CAST(prediction = 0 AS INTEGER) AS p FROM pr),
cf AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn,
              count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp FROM b),
pr2 AS (SELECT *, CASE WHEN tp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                  CASE WHEN tp = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM cf)
SELECT tp, tn, fn, fp, {sig('precision')} AS precision, {sig('recall')} AS recall,
       {sig('CASE WHEN tp = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END')} AS f1 FROM pr2
""")
def centroid_binary_f1(spark, sf):
    """A17/A18 with class 0 as the positive class."""
    p = _centroid_predictions(spark, sf).select(
        (F.col("label") == 0).cast("int").alias("label"), (F.col("prediction") == 0).cast("int").alias("prediction"))
    f = MT.f1_from_confusion(MT.confusion(p))
    return f.select("tp", "tn", "fn", "fp", *[significant(c, SIG).alias(c) for c in ("precision", "recall", "f1")])


@register("length_quality_auc", sql=f"""
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS s, quality AS y FROM documents JOIN labels USING (doc_id)),
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM d),
t AS (SELECT sum(ar) FILTER (WHERE y = 1) AS rs, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS p,
             CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS n FROM r)
SELECT {sig('(rs - p * (p + 1) / 2) / (p * n)')} AS auc, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives FROM t
""")
def length_quality_auc(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "n_chars")
    lab = table(spark, sf, "labels", "doc_id", "quality")
    d = docs.join(lab, "doc_id").select(F.col("n_chars").cast("double").alias("score"),
                                        F.col("quality").alias("label"))
    a = MT.auc(d)
    return a.select(significant("auc", SIG).alias("auc"), "positives", "negatives")
