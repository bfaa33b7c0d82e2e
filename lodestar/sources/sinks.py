"""Sinks K1-K5.  Writers never overwrite by default (``errorifexists``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1: one string column written as text lines."""
    (df.select(F.col(df.columns[0]).cast("string").alias("value"))
       .write.mode(mode).text(path))


def write_sorted_text(df: DataFrame, path: str, *order, mode: str = "errorifexists") -> None:
    """K4: globally ordered output; ``orderBy`` range-partitions, so part files
    are in order and no single task holds the whole result."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    df.orderBy(*order).select(line.alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """K3: long-format vectors and any other table as parquet."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _bounds(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows, least and greatest key of every part."""
    key = F.struct(*order)
    return df.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))


def write_ranges(df: DataFrame, path: str, *order: str, parts: int | None = None) -> None:
    """K3/K4: a table in parts of ascending key ranges, each part sorted, and ``<path>-manifest`` with every
    part's number, rows and key bounds.  No task holds more than one range; how many there are follows the
    data unless ``parts`` says so."""
    ranged = df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranged.write.mode("errorifexists").partitionBy("part").parquet(path)
    spark = df.sparkSession
    _bounds(spark.read.parquet(path), list(order)).write.mode("errorifexists").parquet(f"{path}-manifest")


class BrokenRanges(ValueError):
    """A table of ``write_ranges`` does not match its manifest."""


def read_ranges(spark: SparkSession, path: str, *order: str) -> DataFrame:
    """The rows of ``write_ranges`` with their ``part``.  Raises ``BrokenRanges`` where a part is missing, new, or has
    other rows or bounds than the manifest says, or where two parts' ranges overlap."""
    df, manifest = spark.read.parquet(path), spark.read.parquet(f"{path}-manifest")
    here = _bounds(df, list(order)).select("part", *[F.col(c).alias(f"{c}_here") for c in ("n", "low", "high")])
    pairs = manifest.join(here, "part", "full")
    wrong = pairs.where(~F.struct("n", "low", "high").eqNullSafe(F.struct(
        F.col("n_here").alias("n"), F.col("low_here").alias("low"), F.col("high_here").alias("high"))))
    follows = Window.orderBy("part")            # one row per part
    overlap = manifest.withColumn("before", F.lag("high").over(follows)).where("before > low")
    bad = [f"part {r['part']} differs" for r in wrong.select("part").limit(5).collect()]
    bad += [f"part {r['part']} overlaps the one before" for r in overlap.select("part").limit(5).collect()]
    if bad:
        raise BrokenRanges(f"{path}: {', '.join(bad)}")
    return df


def bounded_collect(df: DataFrame, n: int):
    """K5: bring at most ``n`` rows to the driver (bounded results only)."""
    return df.limit(n).collect()
