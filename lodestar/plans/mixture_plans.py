"""Registered mixture-model queries over ``documents``: document keys
``source/doc_id`` (the id the S8 parse yields), true label = ``source`` (P18), TF over
a 20,000-word vocabulary.  Fixed parameters are the smoothed per-label
estimates, so the posterior and the reports are checkable in SQL, as is one sweep of the Gibbs sampler; its whole
run is checked on rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.numeric import significant
from lodestar.operators import mixture as MX
from lodestar.operators import textfeatures as TF
from lodestar.plans.registry import register
from lodestar.plans.sqlparts import features_ctes, sig
from lodestar.sources.tables import table

VOCAB = 20_000
BETA = 0.5
SIG = 8
TOP_WORDS = 50
TOP_LABELS = 3
GIBBS_CLASSES = 20
GIBBS_ITERATIONS = 200

GDOCS = "(SELECT source || '/' || CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents) AS gdocs"

PARAMS_SQL = f"""
WITH {features_ctes(VOCAB, source=GDOCS)},
dl0 AS (SELECT DISTINCT doc_id, split_part(doc_id, '/', 1) AS label FROM tf),
cls AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS cls FROM (SELECT DISTINCT label FROM dl0)),
dl AS (SELECT doc_id, label, cls FROM dl0 JOIN cls USING (label)),
nc AS (SELECT cls, count(*) AS n FROM dl GROUP BY cls),
lpi AS (SELECT cls, ln(n / (SELECT CAST(sum(n) AS DOUBLE) FROM nc)) AS log_pi FROM nc),
s AS (SELECT cls, pos, sum(tf) AS s FROM tf JOIN dl USING (doc_id) GROUP BY cls, pos),
tot AS (SELECT cls, sum(s) AS tot FROM s GROUP BY cls),
lmu AS (SELECT g.cls, v.pos, ln(({BETA} + coalesce(s.s, 0.0)) / ({BETA * VOCAB} + tot.tot)) AS log_mu
        FROM (SELECT cls FROM nc) g CROSS JOIN (SELECT CAST(range AS INTEGER) AS pos FROM range({VOCAB})) v
        JOIN tot ON tot.cls = g.cls LEFT JOIN s ON s.cls = g.cls AND s.pos = v.pos),
sc AS (SELECT t.doc_id, m.cls, sum(t.tf * m.log_mu) AS ll FROM tf t JOIN lmu m USING (pos) GROUP BY t.doc_id, m.cls),
lp AS (SELECT sc.doc_id, sc.cls, lpi.log_pi + sc.ll AS lp FROM sc JOIN lpi USING (cls)),
ex AS (SELECT doc_id, cls, exp(lp - max(lp) OVER (PARTITION BY doc_id)) AS e FROM lp),
post AS (SELECT doc_id, cls, e / sum(e) OVER (PARTITION BY doc_id) AS prob FROM ex)"""


class _Corpus:
    def __init__(self, spark, sf):
        docs = table(spark, sf, "documents", "doc_id", "text", "source")
        keyed = docs.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
        self.features = TF.TextFeatures(keyed, VOCAB)
        rows = self.features.rows.withColumn("label", T.group_of("doc_id"))
        self.classes = MX.class_index(rows)
        # A row per class goes to every task (the parameters have V numbers per class), so no document moves to its
        # label; the features are written already and every use reads the columns it needs.
        self.rows = rows.join(F.broadcast(self.classes), "label")
        self.log_pi, self.log_mu = MX.mle_params(self.rows, "cls", VOCAB, BETA)

    def posterior(self):
        return MX.posterior_by_blocks(self.rows, self.log_pi.join(self.log_mu, "cls"), VOCAB, ["doc_id", "label"])


@register("mixture_posterior", sql=PARAMS_SQL + f"""
SELECT doc_id, cls, {sig('prob')} AS prob FROM post
""")
def mixture_posterior(spark, sf):
    """M24 on fixed parameters: posterior class probabilities of every document."""
    post = _Corpus(spark, sf).posterior()
    return post.select("doc_id", F.posexplode("post").alias("cls", "prob")).select(
        "doc_id", F.col("cls").cast("int").alias("cls"), significant("prob", SIG).alias("prob"))


@register("mixture_param_check", sql=PARAMS_SQL + f"""
SELECT cls, CAST(count(*) AS INTEGER) AS n_pos, {sig('sum(exp(log_mu))')} AS mu_sum,
       {sig('(SELECT sum(exp(log_pi)) FROM lpi)')} AS pi_sum,
       abs(sum(exp(log_mu)) - 1) <= 0.001 AND abs((SELECT sum(exp(log_pi)) FROM lpi) - 1) <= 0.001
         AND count(*) = {VOCAB} AS ok
FROM lmu GROUP BY cls
""")
def mixture_param_check(spark, sf):
    """The fitted parameters are probability vectors of the right shape."""
    c = _Corpus(spark, sf)
    v = MX.validate_params(c.log_pi, c.log_mu, VOCAB)
    return v.select("cls", "n_pos", significant("mu_sum", SIG).alias("mu_sum"),
                    significant("pi_sum", SIG).alias("pi_sum"), "ok")


@register("mixture_top_words", sql=PARAMS_SQL + f""",
rk AS (SELECT cls, pos, row_number() OVER (PARTITION BY cls ORDER BY {sig('log_mu', 12)} DESC, pos) AS rank FROM lmu)
SELECT cls, CAST(rank AS INTEGER) AS rank, word FROM rk JOIN vocab USING (pos) WHERE rank <= {TOP_WORDS}
""")
def mixture_top_words(spark, sf):
    """The 50 most probable words of every class."""
    c = _Corpus(spark, sf)
    t = MX.top_words(c.log_mu, c.features.vocab, TOP_WORDS)
    return t.select("cls", F.col("rank").cast("int").alias("rank"), "word")


@register("mixture_label_shares", sql=PARAMS_SQL + f""",
best AS (SELECT doc_id, cls AS cluster FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY prob DESC, cls) AS rn
         FROM post) WHERE rn = 1),
cross_n AS (SELECT cluster, split_part(doc_id, '/', 1) AS label, count(*) AS n FROM best GROUP BY ALL),
sh AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS share,
              row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS rank FROM cross_n)
SELECT cluster, CAST(rank AS INTEGER) AS rank, label, n, {sig('share')} AS share FROM sh WHERE rank <= {TOP_LABELS}
""")
def mixture_label_shares(spark, sf):
    """A22/T9 on the posterior-argmax assignment: the top 3 true labels per cluster."""
    post = _Corpus(spark, sf).posterior()
    assigned = post.select("label", MX.argmax_cluster(post).alias("cluster"))
    s = MX.label_shares(assigned, k=TOP_LABELS)
    return s.select("cluster", F.col("rank").cast("int").alias("rank"), "label", "n",
                    significant("share", SIG).alias("share"))


@register("mixture_cluster_sums", sql=PARAMS_SQL + f""",
best AS (SELECT doc_id, cls AS cluster FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY prob DESC, cls) AS rn
         FROM post) WHERE rn = 1),
sz AS (SELECT cluster, count(*) AS n_docs FROM best GROUP BY cluster)
SELECT cluster, n_docs, pos, {sig('sum(tf)')} AS total FROM tf JOIN best USING (doc_id) JOIN sz USING (cluster) GROUP BY cluster, n_docs, pos
""")
def mixture_cluster_sums(spark, sf):
    """A21 on the posterior-argmax assignment: documents and summed TF by position of every cluster."""
    c = _Corpus(spark, sf)
    post = c.posterior()
    assigned = post.select("doc_id", MX.argmax_cluster(post).alias("cluster"))
    sums = MX.cluster_sizes(assigned, c.rows)
    return sums.select("cluster", "n_docs", "pos", significant("total", SIG).alias("total"))


SWEEP_SEED = 11
# One sweep under the fixed parameters: the class is the number of cumulative probabilities <= u.
SWEEP_SQL = PARAMS_SQL + f""",
u AS (SELECT doc_id, CAST(concat('0x', substr(md5(concat('{SWEEP_SEED}:0:', doc_id)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
      FROM (SELECT DISTINCT doc_id FROM tf)),
cum AS (SELECT doc_id, cls, sum(prob) OVER (PARTITION BY doc_id ORDER BY cls ROWS UNBOUNDED PRECEDING) AS cum FROM post),
drawn AS (SELECT doc_id, CAST(least(count(*) FILTER (WHERE cum <= u), count(*) - 1) AS INTEGER) AS cluster
          FROM cum JOIN u USING (doc_id) GROUP BY doc_id)"""


@register("mixture_sweep_assignments", sql=SWEEP_SQL + """
SELECT doc_id, cluster FROM drawn
""")
def mixture_sweep_assignments(spark, sf):
    """M26, one sweep under the fixed parameters: the drawn class of every document."""
    c = _Corpus(spark, sf)
    post = c.posterior().withColumn("u", MX.hash_uniform(SWEEP_SEED, 0, "doc_id"))
    return post.select("doc_id", MX.drawn_class("post", "u").alias("cluster"))


@register("mixture_sweep_sums", sql=SWEEP_SQL + f""",
sz AS (SELECT cluster, count(*) AS n_docs FROM drawn GROUP BY cluster)
SELECT cluster, n_docs, pos, {sig('sum(tf)')} AS total FROM tf JOIN drawn USING (doc_id) JOIN sz USING (cluster) GROUP BY cluster, n_docs, pos
""")
def mixture_sweep_sums(spark, sf):
    """M26, the sums that one sweep hands to the next Dirichlet draw: documents and summed TF of
    every (class, position) that occurs, by the sampler's own pass."""
    c = _Corpus(spark, sf)
    params = c.log_pi.join(c.log_mu, "cls").toArrow().sort_by("cls")        # as many classes as the report below has
    log_mu = np.array(params.column("log_mu").to_pylist())
    parts, _ = MX.sweep_tasks(c.rows)
    sums, _ = MX.sweep_sums(MX.packed(c.rows).repartition(parts), SWEEP_SEED, 0, params.column("log_pi").to_numpy(), log_mu, parts)

    def cells(batches):
        for batch in batches:
            for cls, n, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                values = np.frombuffer(data)
                pos = np.append(np.flatnonzero(values), -1)         # the place -1 carries the documents
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pos), cls), pa.int32()), pa.array(pos, pa.int32()),
                     pa.array(np.append(values[pos[:-1]], n), pa.float64())], names=["cluster", "pos", "total"])

    long = sums.mapInArrow(cells, "cluster int, pos int, total double").groupBy("cluster", "pos").agg(F.sum("total").alias("total"))
    sizes = long.where("pos = -1").select("cluster", F.col("total").cast("long").alias("n_docs"))
    return (long.where("pos >= 0").join(sizes, "cluster")
            .select("cluster", "n_docs", "pos", significant("total", SIG).alias("total")))


@register("mixture_param_required", sql=PARAMS_SQL + f"""
SELECT cls, CAST(count(*) AS INTEGER) AS n_pos, {sig('sum(exp(log_mu))')} AS mu_sum FROM lmu GROUP BY cls
""")
def mixture_param_required(spark, sf):
    """M25's raising form on the fitted parameters: all classes pass; a wrong one fails the job by name."""
    c = _Corpus(spark, sf)
    return MX.require_valid(MX.validate_params(c.log_pi, c.log_mu, VOCAB)).select("cls", "n_pos", significant("mu_sum", SIG).alias("mu_sum"))


@register("gibbs_mixture_clusters", note="seeded sampler: rows-only check")
def gibbs_mixture_clusters(spark, sf):
    """20 classes, 200 Gibbs iterations, alpha = beta = 0.5, running
    hyper-parameters; for every one of the 20 clusters its size, its 50 most
    probable words and its top 3 true labels (empty for an unused cluster)."""
    c = _Corpus(spark, sf)
    res = MX.gibbs(c.rows.select("doc_id", "label", "pos", "x"), GIBBS_CLASSES, VOCAB,
                   iterations=GIBBS_ITERATIONS)
    order = np.argsort(-res.mu, axis=1, kind="stable")[:, :TOP_WORDS]
    best = spark.createDataFrame([(k, r, int(p)) for k, ps in enumerate(order) for r, p in enumerate(ps)],
                                 "cluster int, r int, pos int")
    words = (best.join(F.broadcast(c.features.vocab), "pos").groupBy("cluster")
             .agg(F.array_join(F.array_sort(F.collect_list(F.struct("r", "word")))["word"], " ").alias("top_words")))
    sizes = res.assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    labels = MX.label_shares(res.assigned, k=TOP_LABELS).groupBy("cluster").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("rank", "label")))["label"], " ").alias("top_labels"))
    every = spark.range(GIBBS_CLASSES).select(F.col("id").cast("int").alias("cluster"))
    return (every.join(words, "cluster", "left").join(sizes, "cluster", "left").join(labels, "cluster", "left")
            .select("cluster", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("top_labels", F.lit("")).alias("top_labels"),
                    F.coalesce("top_words", F.lit("")).alias("top_words")))
