"""Registered statistics queries: regression on ``lineitem``, Gram matrix of
``embeddings``, variance-ranked TF features of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.numeric import significant
from lodestar.operators import stats as ST
from lodestar.operators import textfeatures as TF
from lodestar.plans.registry import DIGITS, register
from lodestar.plans.sqlparts import features_ctes, gd_trace_sql, sig
from lodestar.sources.tables import table

VOCAB = 20_000
TOP_M = 10_000
SIG = 8

# Simple regression: x = quantity, y = extended price, both non-zero.
SIMPLE_SQL = ("SELECT l_quantity AS x0, 1.0 AS x1, l_extendedprice AS y FROM lineitem "
              "WHERE l_quantity <> 0 AND l_extendedprice <> 0")
# Multi-feature regression in the taxi layout: x = (1, seconds, distance,
# fare, surcharge), y = total amount; fields 4, 5, 11, 16 non-zero (P5).
MULTI_SQL = """SELECT 1.0 AS x0, l_quantity * 60.0 AS x1, l_discount * 100.0 AS x2, l_extendedprice AS x3,
  l_tax * 10.0 AS x4, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y FROM lineitem
  WHERE l_quantity * 60.0 <> 0 AND l_discount * 100.0 <> 0 AND l_extendedprice <> 0
    AND l_extendedprice * (1 - l_discount) * (1 + l_tax) <> 0"""


def _simple(spark, sf):
    li = table(spark, sf, "lineitem", "l_quantity", "l_extendedprice")
    return li.filter((F.col("l_quantity") != 0) & (F.col("l_extendedprice") != 0))


def _multi(spark, sf):
    li = table(spark, sf, "lineitem", "l_quantity", "l_discount", "l_extendedprice", "l_tax")
    cols = {"secs": F.col("l_quantity") * 60.0, "distance": F.col("l_discount") * 100.0,
            "fare": F.col("l_extendedprice"), "surcharge": F.col("l_tax") * 10.0,
            "total": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))}
    d = li.select(*[v.alias(k) for k, v in cols.items()])
    return d.filter((F.col("secs") != 0) & (F.col("distance") != 0) & (F.col("fare") != 0)
                    & (F.col("total") != 0))


@register("ols_closed_form", sql=f"""
SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
       {sig('regr_slope(l_extendedprice, l_quantity)')} AS slope,
       {sig('regr_intercept(l_extendedprice, l_quantity)')} AS intercept,
       {sig('regr_r2(l_extendedprice, l_quantity)')} AS r2
FROM lineitem WHERE l_quantity <> 0 AND l_extendedprice <> 0
""")
def ols_closed_form(spark, sf):
    fit = ST.ols_fit(_simple(spark, sf), "l_quantity", "l_extendedprice")
    return fit.select(F.col("n").cast("bigint").alias("n"), *[significant(c, SIG).alias(c) for c in ("slope", "intercept", "r2")])


def _trace(spark, rows, names):
    df = ST.trace_frame(spark, rows, names)
    return df.select("iteration", *[significant(c, SIG).alias(c) for c in df.columns[1:]])


@register("simple_regression_gd", sql=gd_trace_sql(SIMPLE_SQL, 2, ["m", "b"], 0.1, 1e-5, 100, True))
def simple_regression_gd(spark, sf):
    """M8: 100 steps, rate 1e-5, m = b = 0.1, gradient 2/n sum, loss before update."""
    stats = ST.gram_stats(_simple(spark, sf), ["l_quantity", 1.0], "l_extendedprice", ["m", "b"])
    return _trace(spark, ST.gd_trace(stats, 0.1, 1e-5, 100, scale_by_n=True), stats.names)


@register("multi_regression_gd", sql=gd_trace_sql(
    MULTI_SQL, 5, ["w0", "w1", "w2", "w3", "w4"], 0.1, 1e-15, 100, False, additive_delta=1e-15))
def multi_regression_gd(spark, sf):
    """M9: 100 steps, rate 1e-15 adjusted by +-1e-15, W = 0.1, gradient without 2/n."""
    d = _multi(spark, sf)
    stats = ST.gram_stats(d, [1.0, "secs", "distance", "fare", "surcharge"], "total",
                          ["w0", "w1", "w2", "w3", "w4"])
    rows = ST.gd_trace(stats, 0.1, 1e-15, 100, scale_by_n=False, step_rule="additive", step_delta=1e-15)
    return _trace(spark, rows, stats.names)


@register("embedding_gram_matrix", sql=f"""
SELECT CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j,
       {sig('sum(CAST(embedding[i] AS DOUBLE) * CAST(embedding[j] AS DOUBLE))', 10)} AS g
FROM embeddings, range(1, 65) a(i), range(1, 65) b(j) WHERE i <= j AND j <= len(embedding) GROUP BY i, j
""")
def embedding_gram_matrix(spark, sf):
    g = ST.gram_matrix(table(spark, sf, "embeddings", "embedding"), "embedding")
    return g.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
                    significant("g", 10).alias("g"))


@register("tf_gram_blocks", sql=f"""
WITH {features_ctes(VOCAB)},
cells AS (SELECT a.pos AS i, b.pos AS j, sum(a.tf * b.tf) AS g FROM tf a JOIN tf b ON a.doc_id = b.doc_id AND a.pos <= b.pos GROUP BY a.pos, b.pos)
SELECT i, count(*) AS n_cells, {sig('sum(g) FILTER (WHERE i = j)')} AS diagonal, {sig('sum(g)')} AS total,
       {sig('sum(g * (j + 1))')} AS weighted FROM cells GROUP BY i
""")
def tf_gram_blocks(spark, sf):
    """J9 over the TF rows of all documents and the whole 20,000-word vocabulary: every
    non-zero cell of X'X, reported per row of the upper triangle."""
    f = TF.TextFeatures(table(spark, sf, "documents", "doc_id", "text"), VOCAB)
    cells = ST.gram_blocks(f.rows, VOCAB)
    return ST.gram_rows(cells).select("i", "n_cells", *[significant(c, SIG).alias(c) for c in ("diagonal", "total", "weighted")])


EXACT_FEATURES = ["secs", "distance", "fare", "surcharge"]


def _exact_sql() -> str:
    """Normal equations of the centred design by elimination, one CTE per column."""
    d = len(EXACT_FEATURES)
    cols = [f"x{i + 1}" for i in range(d)] + ["y"]
    pairs = [(i, j) for i in range(d) for j in range(i, d + 1)]
    a = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    ctes = [f"dm AS ({MULTI_SQL})", "mean AS (SELECT count(*) AS n, " + ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(cols)) + " FROM dm)",
            "e0 AS (SELECT " + ", ".join(f"sum(({cols[i]} - m{i}) * ({cols[j]} - m{j})) AS {a(i, j)}" for i, j in pairs) + " FROM dm, mean)"]
    for k in range(d):
        left = [f"{a(i, j)} - a{k}_{i} * {a(k, j)} / a{k}_{k} AS {a(i, j)}" for i, j in pairs if i > k]
        kept = [a(i, j) for i, j in pairs if i <= k]
        ctes.append(f"e{k + 1} AS (SELECT {', '.join(kept + left)} FROM e{k})")
    for k in reversed(range(d)):
        back = "".join(f" - {a(k, j)} * b{j}" for j in range(k + 1, d))
        ctes.append(f"s{k} AS (SELECT *, ({a(k, d)}{back}) / {a(k, k)} AS b{k} FROM {f's{k + 1}' if k + 1 < d else f'e{d}'})")
    names = [("intercept", f"m{d}" + "".join(f" - b{i} * m{i}" for i in range(d)))] + [(n, f"b{i}") for i, n in enumerate(EXACT_FEATURES)]
    return ("WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(
        f"SELECT '{n}' AS term, {sig(e, 6)} AS coefficient, CAST(n AS BIGINT) AS n, {d} AS rank FROM s0, mean" for n, e in names))


@register("multi_regression_exact", sql=_exact_sql())
def multi_regression_exact(spark, sf):
    """M9's exact alternative on the same rows: one pass of centred moments, pivoted
    Cholesky; finite at every size, where gradient descent at M9's fixed rates diverges."""
    fit = ST.exact_regression(_multi(spark, sf), EXACT_FEATURES, "total")
    rows = [(n, float(b), fit.n, fit.rank) for n, b in zip(["intercept", *fit.names], [fit.intercept, *fit.coefficients], strict=True)]
    return (spark.createDataFrame(rows, "term string, coefficient double, n long, rank int")
            .select("term", significant("coefficient", 6).alias("coefficient"), "n", "rank"))


VAR_SQL = f"""
WITH {features_ctes(VOCAB)},
nd AS (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS n FROM tf),
m AS (SELECT pos, count(*) AS nnz, sum(tf) / (SELECT n FROM nd) AS mean FROM tf GROUP BY pos),
v AS (SELECT pos, nnz, mean,
             (sum((tf - mean) * (tf - mean)) + ((SELECT n FROM nd) - nnz) * mean * mean) / (SELECT n FROM nd) AS variance
      FROM tf JOIN m USING (pos) GROUP BY pos, nnz, mean),
top AS (SELECT * FROM v ORDER BY {sig('variance', 10)} DESC, pos LIMIT {TOP_M})"""


@register("tf_variance_ranking", sql=VAR_SQL + f"""
SELECT CAST(row_number() OVER (ORDER BY {sig('variance', 10)} DESC, pos) AS INTEGER) AS rank, pos,
       {sig('mean')} AS mean, {sig('variance')} AS variance, {sig('ln(variance)')} AS log_variance FROM top
""")
def tf_variance_ranking(spark, sf):
    """Mean and population variance of every TF column over
    the featurised documents; the 10,000 largest variances with ln(variance)."""
    f = TF.TextFeatures(table(spark, sf, "documents", "doc_id", "text"), VOCAB)
    n = f.tf.select(F.count_distinct("doc_id")).scalar()
    top = ST.top_variance(ST.column_moments(f.tf, n), TOP_M)
    return top.select("rank", "pos", *[significant(c, SIG).alias(c) for c in ("mean", "variance", "log_variance")])


@register("variance_selected_features", sql=VAR_SQL + f"""
SELECT doc_id, count(top.pos) AS n_selected, round(coalesce(sum(tf) FILTER (WHERE top.pos IS NOT NULL), 0.0), {DIGITS}) AS tf_selected
FROM tf LEFT JOIN top USING (pos) GROUP BY doc_id
""")
def variance_selected_features(spark, sf):
    """Keep the 10,000 highest-variance positions; a document with none of them stays, with no features."""
    f = TF.TextFeatures(table(spark, sf, "documents", "doc_id", "text"), VOCAB)
    n = f.tf.select(F.count_distinct("doc_id")).scalar()
    top = ST.top_variance(ST.column_moments(f.tf, n), TOP_M)
    kept = ST.select_positions(f.tf, top)
    return kept.groupBy("doc_id").agg(F.count("pos").alias("n_selected"),
                                      F.round(F.coalesce(F.sum("tf"), F.lit(0.0)), DIGITS).alias("tf_selected"))
