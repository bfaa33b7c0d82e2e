"""Tabular classification operators.

Category handling stays in DataFrames: frequency indexing and the category
vocabulary are distributed rankings over *distinct* values (``global_rank``:
no single-partition window) applied back with joins; the multi-hot
encoding is kept sparse (sorted positions).  Model fitting uses pyspark.ml.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.common import global_rank


def typed_projection(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """P10: every listed column checked-cast in one projection; others kept."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (default: any column)."""
    return df.na.drop(subset=subset)


def threshold_label(c, threshold: float) -> Column:
    """1 when the value is >= threshold, else 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col >= threshold, F.lit(1)).otherwise(F.lit(0))


def frequency_index(df: DataFrame, col: str) -> DataFrame:
    """(value, idx) with idx = rank by (frequency desc, value asc) - 1."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("value IS NOT NULL")
    return global_rank(counts, [F.desc("n"), F.asc("value")], "idx").select("value", "idx")


def apply_index(df: DataFrame, col: str, index: DataFrame, out: str) -> DataFrame:
    """Replace categories by their index; unseen values get ``size`` (keep bucket)."""
    size = index.select(F.count(F.lit(1))).scalar()
    return df.join(index.withColumnRenamed("value", col), col, "left").withColumn(out, F.coalesce(F.col("idx"), size.cast("int"))).drop("idx")


def category_vocabulary(df: DataFrame, arr_col: str) -> DataFrame:
    """The union of all category sets, sorted, numbered from 0."""
    cats = df.select(F.explode(arr_col).alias("category")).distinct()
    return global_rank(cats, [F.asc("category")], "idx")


def multi_hot_positions(df: DataFrame, key: str, arr_col: str, vocab: DataFrame) -> DataFrame:
    """(key, positions) -- the sorted vocabulary positions present in the
    row's category set (the sparse form of the multi-hot vector)."""
    exploded = df.select(key, F.explode(F.array_distinct(arr_col)).alias("category"))
    hot = exploded.join(vocab, "category")
    return hot.groupBy(key).agg(F.array_sort(F.collect_list("idx")).alias("positions"))


def hash_split(df: DataFrame, key: str, seed: int, test_percent: int = 10) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by the first 32 bits of md5("seed:key") (the
    same rows land in the same side under any partitioning, retry or engine)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    test = F.coalesce(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < test_percent, F.lit(False))
    return df.filter(~test), df.filter(test)


@dataclass
class OneHot:
    """A fitted one-hot encoder: ``table(col, value, pos)`` and, per column, the first
    position and the position of unseen values; ``width`` positions in all."""

    numeric: list[str]
    table: DataFrame
    unseen: dict[str, int]
    width: int


def _values(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(key, col, value)``: one row per nominal value, one per distinct element of an array
    column; nulls stay (an array's nulls and empty arrays have no row)."""
    out = None
    for c in columns:
        many = df.schema[c].dataType.typeName() == "array"
        value = F.explode(F.array_compact(F.array_distinct(c)).cast("array<string>")) if many else F.col(c).cast("string")
        part = df.select(key, F.lit(c).alias("col"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def fit_one_hot(train: DataFrame, key: str, numeric: list[str], columns: list[str]) -> OneHot:
    """M21's one-hot option.  Numeric columns take the first positions; every nominal or array
    column has a range of its own, its values by (frequency desc, value), and one more position for
    values that training didn't have.  The categories stay a table; the driver sees one
    count per column."""
    seen = _values(train, key, columns).where("value is not null").groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.checkpoint()
    sizes = {r["col"]: r["n"] for r in seen.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
    table, unseen, at = None, {}, len(numeric)
    for c in columns:
        ranked = global_rank(seen.where(F.col("col") == c).select("value", "n"), [F.desc("n"), F.asc("value")], "idx")
        part = ranked.select(F.lit(c).alias("col"), "value", (F.col("idx") + at).cast("int").alias("pos"))
        table = part if table is None else table.unionByName(part)
        unseen[c] = at + sizes.get(c, 0)
        at = unseen[c] + 1
    return OneHot(list(numeric), table, unseen, at)


def encode_one_hot(df: DataFrame, key: str, fitted: OneHot) -> DataFrame:
    """``(key, pos[], x[])`` of every row with a key: positions ascending; numeric nulls are
    left out, a null or unseen nominal value takes the position for unseen values."""
    unseen = F.create_map(*[x for c, p in fitted.unseen.items() for x in (F.lit(c), F.lit(p))])
    hot = (_values(df, key, list(fitted.unseen)).join(fitted.table, ["col", "value"], "left")
           .select(key, F.coalesce("pos", unseen[F.col("col")]).alias("pos"), F.lit(1.0).alias("x")).distinct())
    numbers = df.select(key, F.posexplode(F.array(*[F.col(c).cast("double") for c in fitted.numeric]))).toDF(key, "pos", "x").where("x is not null") \
        if fitted.numeric else None
    long = hot if numbers is None else hot.unionByName(numbers)
    e = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return long.groupBy(key).agg(e.alias("e")).select(key, F.col("e.pos").alias("pos"), F.col("e.x").alias("x"))


def assembled(df: DataFrame, numeric: list[str], positions: str, size: int) -> DataFrame:
    """``features`` = the numeric columns and a 0/1 vector of ``size`` places from the
    position arrays, built inside the JVM; no category is listed anywhere."""
    hot = CountVectorizerModel.from_vocabulary([str(i) for i in range(max(size, 1))], inputCol="_places", outputCol="_hot", binary=True)
    placed = hot.transform(df.withColumn("_places", F.transform(positions, lambda i: i.cast("string"))))
    return (VectorAssembler(inputCols=[*numeric, "_hot"], outputCol="features", handleInvalid="keep").transform(placed)
            .drop("_places", "_hot"))


def classifier(label: str, model: str = "logistic"):
    """Logistic regression (L-BFGS) or a linear SVM on assembled features."""
    if model == "logistic":
        return LogisticRegression(maxIter=100, featuresCol="features", labelCol=label)
    return LinearSVC(maxIter=100, regParam=0.0, featuresCol="features", labelCol=label)
