"""Shared planning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Global top-k with a total order (TakeOrderedAndProject: each task keeps
    k rows, the merge sees at most k rows per task)."""
    return df.orderBy(*order).limit(k)


def global_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """0-based position of every row in the total order ``order`` without a
    single-partition window: rows are range-partitioned on the order keys (as
    many partitions as AQE finds fit), numbered inside their partition, and
    shifted by the row count of all earlier partitions (a prefix sum with one
    row per partition).  The ranged frame is persisted, so both uses see the
    same partitions; ``df`` must hold distinct values only, and ``order`` must
    be a total order (no ties)."""
    from pyspark import StorageLevel
    from pyspark.sql import Window
    ranged = (df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return (ranged.withColumn("_local", local).join(offsets, "_pid")
            .select(*df.columns, (F.col("_off") + F.col("_local") - 1).cast("int").alias(name)))
