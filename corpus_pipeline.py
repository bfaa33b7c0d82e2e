"""Training-data pipeline over ``documents``: five stages, each one operator of lodestar.llm.

Every stage takes the rows that the one before kept (written as Parquet and read
again), so a lost executor costs one stage's tasks at most.  All but the last
return the columns of ``documents``; rows with null or empty texts go through
every stage; extra columns are dropped at the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import fmindex, prefixbpe, quality, scratch, tokengroups, toxicity
from lodestar.session import bound_batches, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.5            # score from which a text is toxic
GOOD_FROM = 0.3             # score from which a text is good enough


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bound_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar rejects go."""
    _prepare(spark)
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant rejects go."""
    _prepare(spark)
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score(docs, model).where(F.col("score") >= GOOD_FROM).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that similarity links join, the one with the smallest doc_id stays.
    Repeated rows stay once; rows without a doc_id, which no group can name, all stay."""
    _prepare(spark)
    docs = docs.select(*COLUMNS)
    found = tokengroups.jaccard_components(docs.select("doc_id", "text"))
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    first = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return first.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; ``n_chars`` follows."""
    _prepare(spark)
    bench = _table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = fmindex.decontaminate(docs.select(*COLUMNS), bench, clean=True)
    size = F.when(F.col("n_hit") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", size).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact token ids of every text and a digest of their decoding."""
    _prepare(spark)
    coded = prefixbpe.encode_decode(docs.select(*COLUMNS), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode),
]

# Learned models, similarity components and BPE: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
