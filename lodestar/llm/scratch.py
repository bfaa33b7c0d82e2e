"""Written intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local master may go
    without that setting: it then gets a fresh temporary folder (tests)."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    set_dir = tempfile.mkdtemp(prefix="lodestar-llm-")
    spark.sparkContext.setCheckpointDir(set_dir)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost
    executors, and every later branch reads the same rows."""
    spark = df.sparkSession
    where = path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(where)
    back = spark.read.schema(df.schema).parquet(where)
    back.scratch_path = where
    return back


def discard(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file on the machine that runs this code."""
    import public_tokenizers
    return public_tokenizers.path(name)
