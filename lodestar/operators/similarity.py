"""Text-query similarity search (M4), neighbour vote (M5), stop-word
comparison (M6) and top-k set overlap (O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.textfeatures import TextFeatures, long_counts

TIE_DIGITS = 9


def query_vector(features: TextFeatures, query: DataFrame,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """J6 + M1 + M3 for the query text(s): ``(qid, pos, w)`` with the query's
    own TF times the corpus IDF.  At most ``size`` rows per query."""
    q_tf = long_counts(features.encode(query, id_col, text_col))
    return (q_tf.join(F.broadcast(features.idf), "pos")
            .select(F.col("doc_id").alias("qid"), "pos", (F.col("tf") * F.col("idf")).alias("w")))


def dot_scores(features: TextFeatures, qvec: DataFrame, normalize: bool = False) -> DataFrame:
    """``(doc_id, score)`` = sum over shared positions of tfidf * w for a
    single query vector (<= size rows, broadcast).  ``normalize`` divides by
    both L2 norms (true cosine); the default is the plain dot product."""
    joined = features.tfidf.join(F.broadcast(qvec.select("pos", "w")), "pos")
    scores = joined.groupBy("doc_id").agg(F.sum(F.col("tfidf") * F.col("w")).alias("score"))
    if normalize:
        doc_norm = features.tfidf.groupBy("doc_id").agg(
            F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("dnorm"))
        q_norm = qvec.select(F.sqrt(F.sum(F.col("w") * F.col("w")))).scalar()
        scores = (scores.join(doc_norm, "doc_id")
                  .select("doc_id", F.try_divide(F.col("score"), F.col("dnorm") * q_norm).alias("score")))
    return scores


def similarity_topk(features: TextFeatures, query: DataFrame, k: int,
                    normalize: bool = False, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """M4: the k documents most similar to one query text, by (score desc,
    doc_id asc).  Every featurised document has a score (0 when it shares no
    word); if fewer than k documents score above 0, the rest of the k are
    filled with zero-score documents by ascending id, exactly as a full
    ranking would.  Every intermediate set is bounded by 2k rows."""
    qvec = query_vector(features, query, id_col, text_col)
    scores = dot_scores(features, qvec, normalize)
    # scores equal to TIE_DIGITS decimals are ties (copies of a document can
    # differ in the last bits by summation order); ties -> smaller doc_id
    key = F.round("score", TIE_DIGITS)
    positive = scores.filter(F.col("score") > 0).orderBy(key.desc(), F.asc("doc_id")).limit(k)
    first_ids = features.arrays.select("doc_id").orderBy("doc_id").limit(2 * k)
    zeros = (first_ids.join(F.broadcast(positive.select("doc_id")), "doc_id", "left_anti")
             .select("doc_id", F.lit(0.0).alias("score")))
    return positive.unionByName(zeros).orderBy(key.desc(), F.asc("doc_id")).limit(k)


def neighbour_vote(neighbours: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """M5 (re-aimed): majority label among the neighbours; ties -> smaller label."""
    votes = (neighbours.join(labels.select("doc_id", F.col(label_col).alias("label")), "doc_id")
             .groupBy("label").agg(F.count(F.lit(1)).alias("votes")))
    return votes.orderBy(F.desc("votes"), F.asc("label")).limit(1)


def overlap(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """O1: keys present in both result lists (set intersection)."""
    return a.select(key).intersect(b.select(key))
