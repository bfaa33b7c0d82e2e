"""Registered text queries over ``documents``, ``benchmark`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import similarity as S
from lodestar.operators import textfeatures as TF
from lodestar.plans.registry import DIGITS, register
from lodestar.plans.sqlparts import features_ctes, query_scores_ctes, vocab_cte, words_cte
from lodestar.sources import readers
from lodestar.sources.tables import grouped_tagged_lines, table, tagged_lines

# Parameters of the registered text queries.
VOCAB = 20_000
TOP_K = 30
FIRST_QUERY_SQL = "SELECT text FROM benchmark ORDER BY item_id LIMIT 1"
STOP_SQL = "word NOT IN (" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.STOP_WORDS) + ")"


def _docs(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text")


def _first_query(spark, sf):
    return (table(spark, sf, "benchmark", "item_id", "text")
            .orderBy("item_id").limit(1).select(F.col("item_id").alias("doc_id"), "text"))


def _r(c, digits=DIGITS):
    return F.round(F.col(c), digits).alias(c)


@register("word_count", sql=f"""
WITH {words_cte('documents')}
SELECT word, count(*) AS n FROM words GROUP BY word
""")
def word_count(spark, sf):
    return TF.word_counts(TF.tokenize(_docs(spark, sf)))


@register("vocabulary", sql=f"""
WITH {words_cte('documents')}, {vocab_cte(VOCAB)}
SELECT word, pos FROM vocab
""")
def vocabulary(spark, sf):
    return TF.vocabulary(TF.tokenize(_docs(spark, sf)), VOCAB)


@register("doc_position_lines", sql=f"""
WITH {features_ctes(VOCAB)}
SELECT doc_id, concat_ws(',', CAST(doc_id AS VARCHAR),
       array_to_string(list_sort(flatten(list(list_resize([pos], n, pos)))), ',')) AS line
FROM terms GROUP BY doc_id
""")
def doc_position_lines(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    return TF.position_lines(f.docs)


@register("term_frequency", sql=f"""
WITH {features_ctes(VOCAB)}
SELECT doc_id, pos, n, round(n / sum(n) OVER (PARTITION BY doc_id), {DIGITS}) AS tf FROM terms
""")
def term_frequency(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    return f.counts.select("doc_id", "pos", "n", _r("tf"))


@register("inverse_document_frequency", sql=f"""
WITH {features_ctes(VOCAB)}
SELECT pos, count(*) AS df, round(ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / count(*)), {DIGITS}) AS idf
FROM terms GROUP BY pos
""")
def inverse_document_frequency(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    return f.df.join(f.idf, "pos").select("pos", "df", _r("idf"))


@register("tfidf_vectors", sql=f"""
WITH {features_ctes(VOCAB)}
SELECT doc_id, pos, round(tfidf, {DIGITS}) AS tfidf FROM tfidf
""")
def tfidf_vectors(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    return f.tfidf.select("doc_id", "pos", _r("tfidf"))


SIMILARITY_SQL = f"""
WITH {features_ctes(VOCAB)},
{query_scores_ctes(FIRST_QUERY_SQL)}
SELECT doc_id, round(score, {DIGITS}) AS score FROM scores ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K}
"""


def similarity_top30(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    top = S.similarity_topk(f, _first_query(spark, sf), TOP_K)
    return top.select("doc_id", _r("score"))


register("tfidf_similarity_top30", sql=SIMILARITY_SQL)(similarity_top30)


@register("cosine_similarity_top30", sql=f"""
WITH {features_ctes(VOCAB)},
{query_scores_ctes(FIRST_QUERY_SQL, name='dots')},
dnorm AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS dn FROM tfidf GROUP BY doc_id),
qnorm AS (SELECT sqrt(sum(w * w)) AS qn FROM qvec),
scores AS (SELECT doc_id, coalesce(score / (dn * (SELECT qn FROM qnorm)), 0.0) AS score FROM dots JOIN dnorm USING (doc_id))
SELECT doc_id, round(score, {DIGITS}) AS score FROM scores ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K}
""")
def cosine_similarity_top30(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    top = S.similarity_topk(f, _first_query(spark, sf), TOP_K, normalize=True)
    return top.select("doc_id", _r("score"))


@register("knn_quality_vote", sql=f"""
WITH {features_ctes(VOCAB)},
{query_scores_ctes(FIRST_QUERY_SQL)},
nn AS (SELECT doc_id FROM scores ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K})
SELECT l.quality AS label, count(*) AS votes FROM nn JOIN labels l USING (doc_id)
GROUP BY l.quality ORDER BY votes DESC, label LIMIT 1
""")
def knn_quality_vote(spark, sf):
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    nn = S.similarity_topk(f, _first_query(spark, sf), TOP_K)
    return S.neighbour_vote(nn, table(spark, sf, "labels", "doc_id", "quality"), "quality")


@register("stopword_similarity_overlap", sql=f"""
WITH {features_ctes(VOCAB)},
{query_scores_ctes(FIRST_QUERY_SQL)},
a AS (SELECT doc_id FROM scores ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K})
SELECT doc_id FROM a
INTERSECT
SELECT doc_id FROM (
  WITH {features_ctes(VOCAB, stop_filter=STOP_SQL)},
  {query_scores_ctes(FIRST_QUERY_SQL)}
  SELECT doc_id FROM scores ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K})
""")
def stopword_similarity_overlap(spark, sf):
    docs, q = _docs(spark, sf), _first_query(spark, sf)
    plain = S.similarity_topk(TF.TextFeatures(docs, VOCAB), q, TOP_K)
    no_stop = S.similarity_topk(TF.TextFeatures(docs, VOCAB, stop_words=T.STOP_WORDS), q, TOP_K)
    return S.overlap(plain, no_stop)


@register("tagged_document_parse", sql="""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(text) AS text_len, md5(text) AS text_md5 FROM documents
""")
def tagged_document_parse(spark, sf):
    lines = tagged_lines(table(spark, sf, "documents", "doc_id", "text", "source"))
    parsed = readers.parse_tagged(lines)
    return parsed.select("doc_id", F.length("text").cast("bigint").alias("text_len"), F.md5("text").alias("text_md5"))


@register("grouped_id_counts", sql="""
SELECT source AS grp, count(*) AS n_docs, count(DISTINCT doc_id) AS n_ids FROM documents GROUP BY source
""")
def grouped_id_counts(spark, sf):
    lines = grouped_tagged_lines(table(spark, sf, "documents", "doc_id", "text", "source"))
    parsed = readers.parse_tagged(lines, skip=14)
    return (parsed.select(T.group_of("doc_id").alias("grp"), "doc_id")
            .groupBy("grp").agg(F.count(F.lit(1)).alias("n_docs"),
                                F.countDistinct("doc_id").alias("n_ids")))


@register("prefix_label_counts", sql="""
SELECT CASE WHEN regexp_matches(source, '^src1') THEN 1 ELSE 0 END AS label, count(*) AS n
FROM documents GROUP BY 1
""")
def prefix_label_counts(spark, sf):
    docs = table(spark, sf, "documents", "source")
    return (docs.select(T.prefix_label("source", "^src1").alias("label"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@register("top_tf_of_longest_doc", sql=f"""
WITH {features_ctes(VOCAB)},
target AS (SELECT doc_id FROM terms GROUP BY doc_id ORDER BY sum(n) DESC, doc_id LIMIT 1),
vals AS (SELECT list_slice(list_concat(list_sort(list(tf), 'DESC'), list_resize([0.0], 100, 0.0)), 1, 100) AS v
         FROM tf WHERE doc_id = (SELECT doc_id FROM target))
SELECT CAST(i AS INTEGER) AS rank, round(v[i] * {VOCAB}.0, {DIGITS}) AS scaled_tf
FROM vals, range(1, 101) AS r(i)
""")
def top_tf_of_longest_doc(spark, sf):
    """The 100 largest TFs (zero-padded) of the document with the
    most in-vocabulary tokens, times the vocabulary size."""
    f = TF.TextFeatures(_docs(spark, sf), VOCAB)
    target = f.arrays.select("doc_id", "total", "n").orderBy(F.desc("total"), "doc_id").limit(1).where("doc_id is not null")
    one = target.select(F.explode("n").alias("n"), "total").select((F.col("n") / F.col("total")).alias("tf"))
    vals = one.agg(F.slice(F.concat(F.sort_array(F.collect_list("tf"), asc=False),
                                    F.array_repeat(F.lit(0.0), 100)), 1, 100).alias("v"))
    return vals.select(F.posexplode("v").alias("i", "x")).select(
        (F.col("i") + 1).cast("int").alias("rank"), F.round(F.col("x") * float(VOCAB), DIGITS).alias("scaled_tf"))


@register("dictionary_point_lookup", sql=f"""
WITH {words_cte('documents')}, {vocab_cte(VOCAB)},
q AS (SELECT DISTINCT lower(unnest(regexp_extract_all(t, '[a-zA-Z]+'))) AS word FROM ({FIRST_QUERY_SQL}) AS s(t))
SELECT word, pos FROM vocab WHERE word IN (SELECT word FROM q)
""")
def dictionary_point_lookup(spark, sf):
    """Dictionary positions of the words of the first benchmark text
    (one semi-join against the distinct query words instead of one filter per word)."""
    vocab = TF.vocabulary(TF.tokenize(_docs(spark, sf)), VOCAB)
    words = TF.all_words(TF.tokenize(_first_query(spark, sf))).select("word").distinct()
    return vocab.join(F.broadcast(words), "word", "left_semi")
