"""pyspark.ml models where the reference used MLlib.

Feature vectors stay sparse and JVM-side: a ``CountVectorizerModel`` built
from our fitted dictionary (at most V words, listed in position order) counts
the in-vocabulary tokens and an L1 ``Normalizer`` turns counts into term
frequencies -- the same numbers as the long-format TF table.
"""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tf_vectors(tokenized: DataFrame, vocab: DataFrame, size: int, keep: DataFrame) -> DataFrame:
    """(doc_id, features) with features = sparse TF over the dictionary, for
    the documents in ``keep`` (doc_id), i.e. those with a dictionary word."""
    words = [r["word"] for r in vocab.orderBy("pos").limit(size).collect()]
    cv = CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="counts")
    counted = cv.transform(tokenized.join(keep.select("doc_id").distinct(), "doc_id", "left_semi"))
    norm = Normalizer(inputCol="counts", outputCol="features", p=1.0)
    return norm.transform(counted).select("doc_id", "features")


def fit_logistic_lbfgs(train: DataFrame, max_iter: int = 100):
    """L-BFGS logistic regression, no intercept, no regularisation."""
    lr = LogisticRegression(maxIter=max_iter, regParam=0.0, fitIntercept=False, tol=1e-6,
                            featuresCol="features", labelCol="label")
    return lr.fit(train)


def fit_linear_svc(train: DataFrame, max_iter: int = 100, reg: float = 0.0):
    """Linear SVM (hinge loss, OWL-QN) replacing SGD training."""
    return LinearSVC(maxIter=max_iter, regParam=reg, featuresCol="features", labelCol="label").fit(train)


def scored(predictions: DataFrame) -> DataFrame:
    """(label, prediction, score) with the raw margin of class 1 as score."""
    return predictions.select(F.col("label").cast("int").alias("label"),
                              F.col("prediction").cast("int").alias("prediction"),
                              vector_to_array("rawPrediction")[1].alias("score"))
