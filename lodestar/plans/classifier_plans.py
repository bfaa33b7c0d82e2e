"""Registered text-classifier queries: documents joined with ``labels``
(label = ``quality``), TF features over a 20,000-word vocabulary.

The split is by ``doc_id`` modulo 10 (0: test); SQL can express it, so two
unrolled steps of every optimiser and the evaluations on them are checked.
Every labelled training document is trained on and every labelled test document
is scored; one without a word of the dictionary is an all-zero row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lodestar.functions.numeric import significant
from lodestar.operators import certificates as CE
from lodestar.operators import linear as LN
from lodestar.operators import metrics as MT
from lodestar.operators import mlmodels as ML
from lodestar.operators import stats as ST
from lodestar.operators import textfeatures as TF
from lodestar.plans.registry import register
from lodestar.plans.sqlparts import features_ctes, sig
from lodestar.sources.tables import table

VOCAB = 20_000
SIG = 8
SELECT_M = 10_000


def is_test(doc_id="doc_id"):
    return F.pmod(F.col(doc_id), F.lit(10)) == 0


def _labels(spark, sf):
    return table(spark, sf, "labels", "doc_id", "quality").select("doc_id", F.col("quality").alias("y"))


def _labelled(docs, labels):
    """(doc_id, y) of the labelled documents of ``docs``."""
    return labels.join(docs.select("doc_id"), "doc_id", "left_semi")


def _all_rows(spark, sf):
    """Features (doc_id, pos[], x[]) of all documents and the labels of the labelled ones."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    return TF.TextFeatures(docs, VOCAB).rows, _labelled(docs, _labels(spark, sf))


def _all_design(spark, sf):
    return LN.SparseDesign.of(*_all_rows(spark, sf), VOCAB)


class _Split:
    """Vocabulary fitted on the training documents; test documents encoded
    with that dictionary (J2)."""

    def __init__(self, spark, sf, select_m: int | None = None):
        docs = table(spark, sf, "documents", "doc_id", "text")
        self.spark = spark
        train_docs, test_docs = docs.filter(~is_test()), docs.filter(is_test())
        labels = _labels(spark, sf)
        self.train_labels, self.test_labels = _labelled(train_docs, labels), _labelled(test_docs, labels)
        f = TF.TextFeatures(train_docs, VOCAB)
        self.features = f
        self.train_tokens = f.tokenized
        self.test_tokens = TF.tokenize(test_docs)
        train, test = f.rows, TF.tf_arrays(f.encode(test_docs))
        self.size = VOCAB
        if select_m:
            n = self.train_labels.select(F.count(F.lit(1))).scalar()
            labelled = f.tf.join(self.train_labels, "doc_id", "left_semi")
            # re-number the selected positions 0..m-1 (dense weight rows)
            top = ST.top_variance(ST.column_moments(labelled, n), select_m).select("pos", "rank").toArrow()
            at = np.full(VOCAB, -1)
            at[top.column("pos").to_numpy()] = top.column("rank").to_numpy() - 1
            train, test = LN.renumbered(train, at), LN.renumbered(test, at)
            self.size = select_m
        self.design = LN.SparseDesign.of(train, self.train_labels, self.size)
        self.test = (test.join(self.test_labels, "doc_id", "left_semi")
                     .select("doc_id", F.explode(F.arrays_zip("pos", "x")).alias("e")).select("doc_id", "e.pos", "e.x"))

    def evaluate(self, w: np.ndarray, two_class: bool = False, predict=LN.predict_threshold):
        """Predictions of every labelled test document, and the F1 report."""
        scores = LN.linear_scores(self.test, self.test_labels, w)
        pred = LN.predict_argmax2(scores) if two_class else predict(scores)
        joined = pred.join(self.test_labels.withColumnRenamed("y", "label"), "doc_id")
        return joined, MT.f1_from_confusion(MT.confusion(joined))

    def release(self) -> None:
        self.design.release()


TRAIN = "(SELECT * FROM documents WHERE doc_id % 10 <> 0)"


def _bold(steps: int, lr: float, loss: str) -> list[str]:
    """SQL of the rate of each step: M11's rule on the losses before."""
    rates, prev = [f"CAST({lr!r} AS DOUBLE)"], "CAST(1.7976931348623157e308 AS DOUBLE)"
    for k in range(steps - 1):
        rates.append(f"({rates[-1]} * CASE WHEN (SELECT {loss} FROM c{k}) < {prev} THEN 1.05 ELSE 0.5 END)")
        prev = f"(SELECT {loss} FROM c{k})"
    return rates


def _training_ctes(source: str = TRAIN, select_m: int | None = None) -> list[str]:
    """Features, labelled rows ``lab(doc_id, y)``, entries ``d(doc_id, pos, x)`` and weights' positions ``ps``."""
    ctes = [features_ctes(VOCAB, source=source),
            f"lab AS (SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS y FROM labels l SEMI JOIN {source} t USING (doc_id))",
            "nl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab)",
            "d0 AS (SELECT doc_id, pos, tf AS x FROM tf SEMI JOIN lab USING (doc_id))"]
    if select_m is None:
        return [*ctes, "d AS (SELECT * FROM d0)", "remap AS (SELECT pos AS old, pos FROM vocab)", f"ps AS (SELECT CAST(range AS INTEGER) AS pos FROM range({VOCAB}))"]
    return [*ctes,
            "m AS (SELECT pos, count(*) AS nnz, sum(x) / (SELECT n FROM nl) AS mean FROM d0 GROUP BY pos)",
            "v AS (SELECT pos, (sum((x - mean) * (x - mean)) + ((SELECT n FROM nl) - nnz) * mean * mean) / (SELECT n FROM nl) AS variance "
            "FROM d0 JOIN m USING (pos) GROUP BY pos, nnz, mean)",
            f"remap AS (SELECT pos AS old, CAST(row_number() OVER (ORDER BY {sig('variance', 10)} DESC, pos) - 1 AS INTEGER) AS pos "
            f"FROM v ORDER BY {sig('variance', 10)} DESC, pos LIMIT {select_m})",
            "d AS (SELECT doc_id, remap.pos, x FROM d0 JOIN remap ON remap.old = d0.pos)",
            f"ps AS (SELECT CAST(range AS INTEGER) AS pos FROM range({select_m}))"]


def _logistic_ctes(steps: int = 2, lr: float = 0.01, w0: float = 0.01, **kw) -> list[str]:
    ctes = [*_training_ctes(**kw), f"w0 AS (SELECT pos, CAST({w0!r} AS DOUBLE) AS w FROM ps)"]
    for k, rate in enumerate(_bold(steps, lr, "cost")):
        ctes += [f"s{k} AS (SELECT doc_id, sum(x * w) AS s FROM d JOIN w{k} USING (pos) GROUP BY doc_id)",
                 f"t{k} AS (SELECT doc_id, y, coalesce(s, 0.0) AS theta FROM lab LEFT JOIN s{k} USING (doc_id))",
                 f"c{k} AS (SELECT sum(-y * theta + greatest(theta, 0) + ln(1 + exp(-abs(theta)))) AS cost FROM t{k})",
                 f"g{k} AS (SELECT pos, sum(x * (1.0 / (1.0 + exp(-theta)) - y)) AS g FROM d JOIN t{k} USING (doc_id) GROUP BY pos)",
                 f"w{k + 1} AS (SELECT pos, w - {rate} * coalesce(g, 0.0) AS w FROM w{k} LEFT JOIN g{k} USING (pos))"]
    return ctes


def _hinge_ctes(steps: int = 2, lr: float = 0.01, w0: float = 1.5, reg: float = 1.0, **kw) -> list[str]:
    ctes = [*_training_ctes(**kw), f"w0 AS (SELECT pos, CAST({w0!r} AS DOUBLE) AS w FROM ps)"]
    for k, rate in enumerate(_bold(steps, lr, "loss")):
        ctes += [f"s{k} AS (SELECT doc_id, sum(x * w) AS s FROM d JOIN w{k} USING (pos) GROUP BY doc_id)",
                 f"t{k} AS (SELECT doc_id, 2 * y - 1 AS yp, coalesce(s, 0.0) AS theta FROM lab LEFT JOIN s{k} USING (doc_id))",
                 f"c{k} AS (SELECT (SELECT 0.5 * {reg} * sum(w * w) FROM w{k}) + avg(greatest(0.0, 1 - yp * theta)) AS loss FROM t{k})",
                 f"g{k} AS (SELECT pos, sum(CASE WHEN yp * theta < 1 THEN -yp * x ELSE 0.0 END) / (SELECT n FROM nl) AS g "
                 f"FROM d JOIN t{k} USING (doc_id) GROUP BY pos)",
                 f"w{k + 1} AS (SELECT pos, w - {rate} * ({reg} * w + coalesce(g, 0.0)) AS w FROM w{k} LEFT JOIN g{k} USING (pos))"]
    return ctes


def _two_class_ctes(steps: int = 2, lr: float = 0.01, w0: float = 0.1, reg: float = 0.1, **kw) -> list[str]:
    ctes = [*_training_ctes(**kw), f"w0 AS (SELECT pos, CAST({w0!r} AS DOUBLE) AS u, CAST({w0!r} AS DOUBLE) AS w FROM ps)"]
    for k, rate in enumerate(_bold(steps, lr, "loss")):
        ctes += [f"s{k} AS (SELECT doc_id, sum(x * u) AS s0, sum(x * w) AS s1 FROM d JOIN w{k} USING (pos) GROUP BY doc_id)",
                 f"t{k} AS (SELECT doc_id, y, greatest(0.0, CASE WHEN y = 1 THEN coalesce(s0 - s1, 0.0) ELSE coalesce(s1 - s0, 0.0) END + 1) AS margin "
                 f"FROM lab LEFT JOIN s{k} USING (doc_id))",
                 f"c{k} AS (SELECT avg(margin) AS loss FROM t{k})",
                 f"g{k} AS (SELECT pos, sum(CASE WHEN margin > 0 THEN CASE WHEN y = 0 THEN -x ELSE x END ELSE 0.0 END) / (SELECT n FROM nl) AS gu, "
                 f"sum(CASE WHEN margin > 0 THEN CASE WHEN y = 1 THEN -x ELSE x END ELSE 0.0 END) / (SELECT n FROM nl) AS gw "
                 f"FROM d JOIN t{k} USING (doc_id) GROUP BY pos)",
                 f"w{k + 1} AS (SELECT pos, u - {rate} * ({reg} * u + coalesce(gu, 0.0)) AS u, w - {rate} * ({reg} * w + coalesce(gw, 0.0)) AS w "
                 f"FROM w{k} LEFT JOIN g{k} USING (pos))"]
    return ctes


SGD_SEED, SGD_FRACTION = 18, 0.5


def _sgd_ctes(steps: int = 2, rate: float = 1.0, fraction: float = SGD_FRACTION, seed: int = SGD_SEED, **kw) -> list[str]:
    ctes = [*_training_ctes(**kw), "w0 AS (SELECT pos, CAST(0 AS DOUBLE) AS w FROM ps)"]
    for k in range(steps):
        ctes += [f"b{k} AS (SELECT doc_id, 2 * y - 1 AS yp FROM lab WHERE CAST(concat('0x', substr(md5(concat('{seed}:{k + 1}:', doc_id)), 1, 8)) AS BIGINT) "
                 f"< {int(fraction * 2 ** 32)})",
                 f"s{k} AS (SELECT doc_id, sum(x * w) AS s FROM d JOIN w{k} USING (pos) GROUP BY doc_id)",
                 f"t{k} AS (SELECT doc_id, yp, coalesce(s, 0.0) AS theta FROM b{k} LEFT JOIN s{k} USING (doc_id))",
                 f"g{k} AS (SELECT pos, sum(CASE WHEN yp * theta < 1 THEN -yp * x ELSE 0.0 END) / (SELECT count(*) FROM b{k}) AS g "
                 f"FROM d JOIN t{k} USING (doc_id) GROUP BY pos)",
                 f"w{k + 1} AS (SELECT pos, w - {rate} / sqrt({k + 1}) * coalesce(g, 0.0) AS w FROM w{k} LEFT JOIN g{k} USING (pos))"]
    return ctes


def _prediction_ctes(predict: str, steps: int = 2) -> list[str]:
    """Labelled test documents under the training dictionary: ``pr(doc_id, label, prediction)``."""
    return ["tw AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[a-zA-Z]+'))) AS word FROM documents WHERE doc_id % 10 = 0)",
            "tt AS (SELECT doc_id, pos, count(*) AS n FROM tw JOIN vocab USING (word) GROUP BY doc_id, pos)",
            "tx AS (SELECT doc_id, pos AS old, n / sum(n) OVER (PARTITION BY doc_id) AS x FROM tt)",
            f"ts AS (SELECT doc_id, {predict} AS p FROM tx JOIN remap USING (old) JOIN w{steps} ON w{steps}.pos = remap.pos GROUP BY doc_id)",
            "pr AS (SELECT l.doc_id, l.quality AS label, coalesce(p, {none}) AS prediction FROM labels l JOIN documents USING (doc_id) "
            "LEFT JOIN ts USING (doc_id) WHERE l.doc_id % 10 = 0)"]


def _f1_sql(ctes: list[str]) -> str:
    return "WITH " + ",\n".join(ctes) + f""",
cf AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp FROM pr),
q AS (SELECT *, CASE WHEN tp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM cf)
SELECT tp, tn, fn, fp, {sig('precision')} AS precision, {sig('recall')} AS recall,
       {sig('CASE WHEN tp = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END')} AS f1 FROM q"""


def _rounded_f1(f1):
    return f1.select("tp", "tn", "fn", "fp", *[significant(c, SIG).alias(c) for c in ("precision", "recall", "f1")])


_THRESHOLD = [x.replace("{none}", "1") for x in _prediction_ctes("CAST(sum(x * w) >= 0 AS INTEGER)")]
_POSITIVE = [x.replace("{none}", "0") for x in _prediction_ctes("CAST(sum(x * w) > 0 AS INTEGER)")]
_ARGMAX = [x.replace("{none}", "0") for x in _prediction_ctes("CAST(sum(x * w) > sum(x * u) AS INTEGER)")]


@register("logreg_gd_two_steps", sql="WITH " + ",\n".join(_logistic_ctes(source="documents")) + f"\nSELECT pos, {sig('w')} AS w FROM w2")
def logreg_gd_two_steps(spark, sf):
    """M10/A23/M11 unrolled: weights after two full-batch steps (all labelled
    documents, rate 0.01, initial weight 0.01, bold driver between steps)."""
    design = _all_design(spark, sf)
    w, _ = LN.train_logistic(design, max_iter=2, tol=0.0)
    design.release()
    return LN.weight_table(spark, w).select("pos", significant("w0", SIG).alias("w"))


@register("svm_hinge_two_steps", sql="WITH " + ",\n".join(_hinge_ctes(source="documents")) + f"\nSELECT pos, {sig('w')} AS w FROM w2")
def svm_hinge_two_steps(spark, sf):
    """M15/A24/F12 unrolled: weights after two steps (all labelled documents, W = 1.5, rate 0.01, reg 1.0)."""
    design = _all_design(spark, sf)
    w, _ = LN.train_hinge(design, max_iter=2)
    design.release()
    return LN.weight_table(spark, w).select("pos", significant("w0", SIG).alias("w"))


@register("svm_two_class_two_steps", sql="WITH " + ",\n".join(_two_class_ctes(select_m=SELECT_M))
          + f"\nSELECT pos, {sig('u')} AS w0, {sig('w')} AS w1 FROM w2")
def svm_two_class_two_steps(spark, sf):
    """M16/M17 unrolled: both weight columns after two steps over the selected positions of the training split."""
    sp = _Split(spark, sf, select_m=SELECT_M)
    w, _ = LN.train_two_class(sp.design, max_iter=2)
    sp.release()
    return LN.weight_table(spark, w).select("pos", *[significant(c, SIG).alias(c) for c in ("w0", "w1")])


@register("logreg_two_steps_evaluate", sql=_f1_sql([*_logistic_ctes(), *_THRESHOLD]))
def logreg_two_steps_evaluate(spark, sf):
    """J2/M13/A17/A18 on the weights after two steps: threshold theta >= 0 on the labelled test documents."""
    sp = _Split(spark, sf)
    w, _ = LN.train_logistic(sp.design, max_iter=2, tol=0.0)
    return _rounded_f1(sp.evaluate(w)[1])


@register("svm_two_class_two_steps_evaluate", sql=_f1_sql([*_two_class_ctes(select_m=SELECT_M), *_ARGMAX]))
def svm_two_class_two_steps_evaluate(spark, sf):
    """J2/F13/M16/M17 on the weights after two steps: the larger column wins."""
    sp = _Split(spark, sf, select_m=SELECT_M)
    w, _ = LN.train_two_class(sp.design, max_iter=2)
    return _rounded_f1(sp.evaluate(w, two_class=True)[1])


@register("logreg_two_steps_false_positives", sql="WITH " + ",\n".join([*_logistic_ctes(), *_THRESHOLD]) + """
SELECT doc_id, md5(text) AS text_md5 FROM documents
WHERE doc_id IN (SELECT doc_id FROM pr WHERE label = 0 AND prediction = 1 ORDER BY doc_id LIMIT 3)""")
def logreg_two_steps_false_positives(spark, sf):
    """J4/P14/T10 on the weights after two steps: the three lowest-id false positives."""
    sp = _Split(spark, sf)
    w, _ = LN.train_logistic(sp.design, max_iter=2, tol=0.0)
    return _false_positives(spark, sf, sp, w).select("doc_id", F.md5("text").alias("text_md5"))


def _false_positives(spark, sf, sp, w):
    joined, _ = sp.evaluate(w)
    fp = joined.filter((F.col("label") == 0) & (F.col("prediction") == 1)).select("doc_id") \
        .orderBy("doc_id").limit(3)
    return table(spark, sf, "documents", "doc_id", "text").join(F.broadcast(fp), "doc_id", "left_semi")


@register("svm_sgd_two_steps", sql="WITH " + ",\n".join(_sgd_ctes()) + f"\nSELECT pos, {sig('w')} AS w FROM w2")
def svm_sgd_two_steps(spark, sf):
    """M18 by SGD, unrolled: weights after two mini-batch steps (half of the rows each, rate 1 / sqrt(t))."""
    sp = _Split(spark, sf)
    w, _ = LN.train_svm_sgd(sp.design, fraction=SGD_FRACTION, max_iter=2, tol=0.0, seed=SGD_SEED)
    sp.release()
    return LN.weight_table(spark, w).select("pos", significant("w0", SIG).alias("w"))


@register("svm_sgd_two_steps_evaluate", sql=_f1_sql([*_sgd_ctes(), *_POSITIVE]))
def svm_sgd_two_steps_evaluate(spark, sf):
    """M18/J2/A17/A18 on the weights after two SGD steps: margin > 0 on the labelled test documents."""
    sp = _Split(spark, sf)
    w, _ = LN.train_svm_sgd(sp.design, fraction=SGD_FRACTION, max_iter=2, tol=0.0, seed=SGD_SEED)
    return _rounded_f1(sp.evaluate(w, predict=LN.predict_positive)[1])


@register("svm_sgd_evaluate", note="iterative optimiser: rows-only check")
def svm_sgd_evaluate(spark, sf):
    """M18 by SGD, whole run as in the reference (100 steps over all rows, no regularisation), beside
    the same loss by OWL-QN: both models' report on the labelled test documents."""
    sp = _Split(spark, sf)
    w, trace = LN.train_svm_sgd(sp.design)
    f1 = sp.evaluate(w, predict=LN.predict_positive)[1]
    sgd = f1.select(F.lit("sgd").alias("model"), "tp", "tn", "fn", "fp", "precision", "recall", "f1", F.lit(len(trace.rows)).alias("steps"))
    other = _ml_evaluate(spark, sf, ML.fit_linear_svc, sp)
    return sgd.unionByName(other.select(F.lit("owlqn").alias("model"), "tp", "tn", "fn", "fp", "precision", "recall", "f1", F.lit(None).cast("int").alias("steps")))


NORM_TOL, NORM_STEPS = 0.05, 3


@register("logreg_norm_stop", sql="WITH " + ",\n".join(_logistic_ctes(steps=NORM_STEPS, source="documents")) + ",\n" + ",\n".join(
    f"n{k} AS (SELECT sqrt(sum((b.w - a.w) * (b.w - a.w))) AS norm FROM w{k} a JOIN w{k + 1} b USING (pos))" for k in range(NORM_STEPS)) + f"""
SELECT CAST(CASE {' '.join(f'WHEN (SELECT norm FROM n{k}) <= {NORM_TOL} THEN {k + 1}' for k in range(NORM_STEPS))} ELSE {NORM_STEPS} END AS INTEGER) AS steps,
       (SELECT least({', '.join(f'(SELECT norm FROM n{k})' for k in range(NORM_STEPS))}) <= {NORM_TOL}) AS by_norm
""")
def logreg_norm_stop(spark, sf):
    """The number of steps until the step norm is at most 0.05 (three at most), and whether the rule ended the run."""
    design = _all_design(spark, sf)
    _, trace = LN.train_logistic(design, max_iter=NORM_STEPS, tol=NORM_TOL)
    design.release()
    return spark.createDataFrame([(len(trace.rows), trace.rows[-1][3] <= NORM_TOL)], "steps int, by_norm boolean")


@register("logreg_gd_train", note="iterative optimiser: rows-only check")
def logreg_gd_train(spark, sf):
    """Up to 100 steps, stop when the step norm <= 1e-8; the trace."""
    design = _all_design(spark, sf)
    _, trace = LN.train_logistic(design)
    design.release()
    return trace.frame(spark, ["cost", "lr", "step"])


@register("logreg_gd_evaluate", note="iterative optimiser: rows-only check")
def logreg_gd_evaluate(spark, sf):
    """Train on the train split, threshold theta >= 0 on test."""
    sp = _Split(spark, sf)
    w, _ = LN.train_logistic(sp.design)
    _, f1 = sp.evaluate(w)
    return f1


@register("logreg_false_positives", note="iterative optimiser: rows-only check")
def logreg_false_positives(spark, sf):
    """The three lowest-id false positives of the test split with
    their text (left-semi join against the documents)."""
    sp = _Split(spark, sf)
    w, _ = LN.train_logistic(sp.design)
    return _false_positives(spark, sf, sp, w)


@register("svm_hinge_train", note="iterative optimiser: rows-only check")
def svm_hinge_train(spark, sf):
    """100 steps, W = 1.5, rate 0.01, reg 1.0, labels +-1; the trace."""
    design = _all_design(spark, sf)
    _, trace = LN.train_hinge(design)
    design.release()
    return trace.frame(spark, ["loss", "lr"])


@register("svm_hinge_evaluate", note="iterative optimiser: rows-only check")
def svm_hinge_evaluate(spark, sf):
    sp = _Split(spark, sf)
    w, _ = LN.train_hinge(sp.design)
    _, f1 = sp.evaluate(w)
    return f1


@register("svm_two_class_evaluate", note="iterative optimiser: rows-only check")
def svm_two_class_evaluate(spark, sf):
    """Top-10,000 variance positions fitted on train, two-column SVM,
    argmax prediction on test."""
    sp = _Split(spark, sf, select_m=SELECT_M)
    w, _ = LN.train_two_class(sp.design)
    _, f1 = sp.evaluate(w, two_class=True)
    return f1


@register("lbfgs_logreg_evaluate", note="library optimiser: rows-only check")
def lbfgs_logreg_evaluate(spark, sf):
    """Pyspark.ml LogisticRegression (L-BFGS, 100 iterations,
    no intercept, no regularisation) on sparse TF vectors; AUC from raw margins."""
    return _ml_evaluate(spark, sf, ML.fit_logistic_lbfgs)


@register("linear_svc_evaluate", note="library optimiser: rows-only check")
def linear_svc_evaluate(spark, sf):
    """Pyspark.ml LinearSVC (100 iterations, regParam 0) on the same split."""
    return _ml_evaluate(spark, sf, ML.fit_linear_svc)


def _certificate_sql(ctes: list[str], loss: str, factor: str, own: str, scale: str, gap: str = "") -> str:
    """Loss and gradient at the weights ``w2`` of the given steps, from the rows ``d`` and ``lab``."""
    return "WITH " + ",\n".join(ctes) + f""",
zs AS (SELECT doc_id, sum(x * w) AS s FROM d JOIN w2 USING (pos) GROUP BY doc_id),
zt AS (SELECT doc_id, y, 2 * y - 1 AS yp, coalesce(s, 0.0) AS theta FROM lab LEFT JOIN zs USING (doc_id)),
zg AS (SELECT pos, sum(x * ({factor})) AS g FROM d JOIN zt USING (doc_id) GROUP BY pos),
zv AS (SELECT {own} + {scale} * coalesce(g, 0.0) AS g, coalesce(g, 0.0) * {scale} AS data, w FROM w2 LEFT JOIN zg USING (pos)),
zn AS (SELECT sqrt(sum(g * g)) AS norm, max(abs(g)) AS most, sum(data * data) AS data, sum(w * w) AS ww FROM zv),
zl AS (SELECT count(*) AS rows, {loss} AS loss, avg(CASE WHEN yp * theta < 1 THEN 1.0 ELSE 0.0 END) AS dual FROM zt)
SELECT rows, {sig('loss')} AS loss, {sig('norm')} AS gradient_norm, {sig('most')} AS gradient_max{gap} FROM zl, zn"""


@register("logistic_certificate_two_steps", sql=_certificate_sql(
    _logistic_ctes(source="documents"), "sum(-y * theta + greatest(theta, 0) + ln(1 + exp(-abs(theta))))", "1.0 / (1.0 + exp(-theta)) - y", "0.0", "1.0"))
def logistic_certificate_two_steps(spark, sf):
    """M14's certificate (loss and gradient by plain aggregates) at the weights after two full-batch steps."""
    features, labels = _all_rows(spark, sf)
    design = LN.SparseDesign.of(features, labels, VOCAB)
    w, _ = LN.train_logistic(design, max_iter=2, tol=0.0)
    design.release()
    return _rounded_certificate(CE.logistic_certificate(features, labels, w))


@register("hinge_certificate_two_steps", sql=_certificate_sql(
    _hinge_ctes(source="documents"), "(SELECT 0.5 * ww FROM zn) + avg(greatest(0.0, 1 - yp * theta))", "CASE WHEN yp * theta < 1 THEN -yp ELSE 0.0 END",
    "w", "1.0 / (SELECT n FROM nl)", f", {sig('loss - (dual - data / 2)')} AS gap"))
def hinge_certificate_two_steps(spark, sf):
    """M18's certificate (loss, subgradient and duality gap, reg 1.0) at the weights after two steps of M15."""
    features, labels = _all_rows(spark, sf)
    design = LN.SparseDesign.of(features, labels, VOCAB)
    w, _ = LN.train_hinge(design, max_iter=2)
    design.release()
    return _rounded_certificate(CE.hinge_certificate(features, labels, w, reg=1.0))


def _rounded_certificate(found):
    return found.select("rows", *[significant(c, SIG).alias(c) for c in found.columns if c != "rows"])


@register("optimum_certificates", note="library optimiser: rows-only check")
def optimum_certificates(spark, sf):
    """M14 and M18 certified: loss and (sub)gradient of the weights that L-BFGS and OWL-QN end with and of zero
    weights, recomputed by plain aggregates over the labelled training rows."""
    sp = _Split(spark, sf)
    features = sp.features.rows
    train = _ml_rows(sp, sp.train_tokens, sp.train_labels)
    found = []
    for model, fit, check in (("lbfgs", ML.fit_logistic_lbfgs, CE.logistic_certificate), ("owlqn", ML.fit_linear_svc, CE.hinge_certificate)):
        fitted = fit(train)
        w = fitted.coefficients.toArray()
        # LinearSVC keeps an intercept, which is no position: its certificate is that of the weights with it.
        shift = float(fitted.intercept)
        rows, size = features, VOCAB
        if shift:
            each = sp.train_labels.groupBy("doc_id").agg(F.count(F.lit(1)).cast("double").alias("n")).join(features, "doc_id", "left")
            rows = each.select("doc_id", F.concat(F.coalesce("pos", F.array().cast("array<int>")), F.array(F.lit(VOCAB))).alias("pos"),
                               F.concat(F.coalesce("x", F.array().cast("array<double>")), F.array("n")).alias("x"))
            w, size = np.append(w, shift), VOCAB + 1
        for state, at in (("start", np.zeros(size)), ("fitted", w)):
            got = check(rows, sp.train_labels, at)
            found.append(got.select(F.lit(model).alias("model"), F.lit(state).alias("state"), "rows", "loss", "gradient_norm", "gradient_max"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ml_rows(sp, tokens, lab):
    return (ML.tf_vectors(tokens, sp.features.vocab, VOCAB, lab)
            .join(lab.select("doc_id", F.col("y").cast("double").alias("label")), "doc_id"))


def _ml_evaluate(spark, sf, fit, sp=None):
    sp = sp or _Split(spark, sf)
    train, test = (_ml_rows(sp, tokens, lab) for tokens, lab in ((sp.train_tokens, sp.train_labels), (sp.test_tokens, sp.test_labels)))
    scored = ML.scored(fit(train).transform(test))
    f1 = MT.f1_from_confusion(MT.confusion(scored))
    return f1.withColumn("auc", MT.auc(scored).select("auc").scalar())


@register("label_balance", sql="""
SELECT CAST(sum(quality) AS BIGINT) AS positives, count(*) AS rows FROM labels
""")
def label_balance(spark, sf):
    """Number of positive labels and of labelled documents."""
    return ST.positive_count(_labels(spark, sf).withColumnRenamed("y", "label"))
