"""Registered tabular queries over ``part``: label = retail price >= 950,
nominal columns brand and type, categories = the words of the part name
(written ``a|b`` and split on ``|`` as the genre field is)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.numeric import significant
from lodestar.operators import metrics as MT
from lodestar.operators import mlmodels as ML
from lodestar.operators import tabular as TB
from lodestar.plans.registry import register
from lodestar.session import staged
from lodestar.sources.tables import table

THRESHOLD = 950.0
SEED = 12345
SIG = 8


def _parts(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    # P10: one checked-cast projection; P11: rows with nulls dropped; P12: label.
    typed = TB.typed_projection(part, {"p_size": "int", "p_retailprice": "double"})
    clean = TB.drop_nulls(typed)
    genres = F.regexp_replace("p_name", " ", "|")
    return clean.select("p_partkey", "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"),
                        TB.threshold_label("p_retailprice", THRESHOLD).alias("target"),
                        T.split_bar(genres).alias("categories"))


@register("string_index_brand_type", sql="""
SELECT 'p_brand' AS col, p_brand AS value,
       CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS idx FROM part GROUP BY p_brand
UNION ALL
SELECT 'p_type', p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) FROM part GROUP BY p_type
""")
def string_index_brand_type(spark, sf):
    """Frequency-ordered indices (ties alphabetical) of brand and type."""
    p = _parts(spark, sf)
    b = TB.frequency_index(p, "p_brand").select(F.lit("p_brand").alias("col"), "value", "idx")
    t = TB.frequency_index(p, "p_type").select(F.lit("p_type").alias("col"), "value", "idx")
    return b.unionByName(t)


@register("category_vocabulary", sql="""
SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS category FROM part)
""")
def category_vocabulary(spark, sf):
    """Sorted union of every part's category set."""
    return TB.category_vocabulary(_parts(spark, sf), "categories")


@register("category_multi_hot", sql="""
WITH voc AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx
             FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS category FROM part)),
bi AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS brand_idx FROM part GROUP BY p_brand),
ti AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) AS type_idx FROM part GROUP BY p_type),
hot AS (SELECT p_partkey, array_to_string(list_sort(list(DISTINCT idx)), ',') AS hot
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS category FROM part) JOIN voc USING (category)
        GROUP BY p_partkey)
SELECT p_partkey, CASE WHEN p_retailprice >= 950.0 THEN 1 ELSE 0 END AS target, CAST(p_size AS DOUBLE) AS p_size,
       brand_idx, type_idx, hot
FROM part JOIN bi USING (p_brand) JOIN ti USING (p_type) JOIN hot USING (p_partkey)
""")
def category_multi_hot(spark, sf):
    """P20/F6/F19/M19/M21 inputs: the model row of every part -- label,
    numeric size, brand and type indices and the multi-hot category
    positions."""
    p = _parts(spark, sf)
    voc = TB.category_vocabulary(p, "categories")
    hot = TB.multi_hot_positions(p, "p_partkey", "categories", voc)
    rows = TB.apply_index(p, "p_brand", TB.frequency_index(p, "p_brand"), "brand_idx")
    rows = TB.apply_index(rows, "p_type", TB.frequency_index(p, "p_type"), "type_idx")
    return (rows.join(hot, "p_partkey")
            .select("p_partkey", "target", "p_size", "brand_idx", "type_idx",
                    F.concat_ws(",", F.transform("positions", lambda x: x.cast("string"))).alias("hot")))


def _one_hot_sql() -> str:
    side = f"CAST(concat('0x', substr(md5(concat('{SEED}:', p_partkey)), 1, 8)) AS BIGINT) % 100 < 10"
    rank = lambda c: f"SELECT {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM"
    return f"""
WITH p AS (SELECT *, {side} AS is_test FROM part),
w AS (SELECT DISTINCT p_partkey, is_test, unnest(string_split(p_name, ' ')) AS word FROM p),
b AS ({rank('p_brand')} p WHERE NOT is_test GROUP BY p_brand),
t AS ({rank('p_type')} p WHERE NOT is_test GROUP BY p_type),
c AS ({rank('word')} w WHERE NOT is_test GROUP BY word),
o AS (SELECT 1 AS b0, 2 + (SELECT count(*) FROM b) AS t0, 3 + (SELECT count(*) FROM b) + (SELECT count(*) FROM t) AS c0,
             (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM t) AS nt, (SELECT count(*) FROM c) AS nc),
e AS (
  SELECT p_partkey, 0 AS pos, CAST(p_size AS DOUBLE) AS x FROM p
  UNION ALL SELECT p_partkey, b0 + coalesce(idx, nb), 1.0 FROM o, p LEFT JOIN b ON b.value = p_brand
  UNION ALL SELECT p_partkey, t0 + coalesce(idx, nt), 1.0 FROM o, p LEFT JOIN t ON t.value = p_type
  UNION ALL SELECT DISTINCT p_partkey, c0 + coalesce(idx, nc), 1.0 FROM o, w LEFT JOIN c ON c.value = word)
SELECT p.p_partkey, is_test, CASE WHEN p_retailprice >= {THRESHOLD} THEN 1 ELSE 0 END AS target,
  string_agg(concat(pos, ':', CAST(x AS VARCHAR)), ' ' ORDER BY pos) AS features FROM p JOIN e USING (p_partkey) GROUP BY ALL
"""


@register("one_hot_rows", sql=_one_hot_sql())
def one_hot_rows(spark, sf):
    """M20/M21 with the one-hot option: the split side, label and sparse feature row of every
    part; brand, type and name words have ranges fitted on the training side, each with a place
    for unseen values."""
    p = _parts(spark, sf)
    train, test = TB.hash_split(p, "p_partkey", SEED)
    fitted = TB.fit_one_hot(train, "p_partkey", ["p_size"], ["p_brand", "p_type", "categories"])
    sides = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    cells = F.transform(F.arrays_zip("pos", "x"), lambda e: F.concat(e["pos"].cast("string"), F.lit(":"), e["x"].cast("string")))
    return (sides.join(TB.encode_one_hot(p, "p_partkey", fitted), "p_partkey")
            .select("p_partkey", "is_test", "target", F.array_join(cells, " ").alias("features")))


@register("tabular_classifier_metrics", note="library optimisers: rows-only check")
def tabular_classifier_metrics(spark, sf):
    """M20-M22 with M14/M18/A25/A26: hash split 90/10 (seed 12345); indices and categories
    fitted on the training side and kept as tables; logistic regression (L-BFGS, 100 iterations)
    and a linear SVM (100 iterations, no regularisation); AUC from raw margins
    and per-class metrics on the test side."""
    p = _parts(spark, sf)
    fit_on, _ = TB.hash_split(p, "p_partkey", SEED)
    voc = TB.category_vocabulary(fit_on, "categories")
    rows = p.join(TB.multi_hot_positions(p, "p_partkey", "categories", voc), "p_partkey", "left")
    for c in ("p_brand", "p_type"):
        rows = TB.apply_index(rows, c, TB.frequency_index(fit_on, c), f"{c}_idx")
    rows = rows.withColumn("positions", F.coalesce("positions", F.array().cast("array<int>")))
    made = TB.assembled(rows, ["p_size", "p_brand_idx", "p_type_idx"], "positions", voc.count())
    # The features are made once and kept for both models.
    made = staged(made.select("p_partkey", "features", F.col("target").cast("double").alias("label")), "tabular")
    train, test = TB.hash_split(made, "p_partkey", SEED)
    out = None
    for model in ("logistic", "svm"):
        scored = ML.scored(TB.classifier("label", model).fit(train).transform(test))
        pc = MT.per_class_metrics(scored)
        row = (MT.overall_metrics(pc)
               .withColumn("auc", MT.auc(scored).select("auc").scalar())
               .select(F.lit(model).alias("model"), *[significant(c, SIG).alias(c) for c in
                       ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "auc")]))
        out = row if out is None else out.unionByName(row)
    return out
