"""Sharding by a two-pass external shuffle (operator 8).

Pass 1 scatters the rows into buckets of memory size by a seeded hash of
the row, and of its copy number where the copies of a row are a good part of a
bucket; pass 2 puts each bucket into a canonical order, shuffles it by
Fisher-Yates with a generator seeded by (seed, bucket), and writes it.  The
buckets one after the other are a uniform order of all rows; row g of
that order goes to shard g mod n as its slot g div n, so row counts differ by
one at most.  The same rows and seed give the same shards whatever the
partitions were, also when a task is run again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm import scratch

BUCKET_BYTES = 32 << 20
BUCKETS_PER_TASK = 4        # on average


def _fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    order = np.arange(n)
    # Row i changes places with a uniform row of i..n-1, for every i.
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def _many_copies(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """``rows`` without those whose copies together exceed ``most`` bytes, and these with
    a ``copy`` number.  They are counted and made again from one row each, in pieces of
    about ``most`` bytes, so that no task holds them all; last, the tables that were written for it."""
    rows = rows.withColumns({"size": F.coalesce(F.octet_length("text"), F.lit(0)) + 8, "h": F.xxhash64("doc_id", "text")})
    # Written, so that Spark knows its size and sends it to all tasks only below its own threshold.
    heavy = scratch.stage(rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.max("size").cast("long").alias("s"))
                          .where(F.col("c") > 1).where(F.col("c") * F.col("s") > most).select("h"), "heavy")
    counted = scratch.stage(rows.join(heavy, "h", "left_semi").groupBy("doc_id", "text", "size").agg(F.count(F.lit(1)).alias("c")), "copies")
    piece = F.greatest(F.lit(1), F.floor(F.lit(most) / F.col("size"))).cast("long")
    pieces = (counted.withColumn("piece", piece)
              .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.col("piece"))))
              .repartition(F.col("doc_id"), F.col("first"), F.xxhash64("text")))
    copies = pieces.select("doc_id", "text", F.explode(F.sequence("first", F.least(F.col("first") + F.col("piece"), F.col("c")) - 1)).alias("copy"))
    return rows.join(heavy, "h", "left_anti"), copies, [heavy, counted]


def write_shards(documents: DataFrame, shards: int = 24, seed: int = 0, key: str = "doc_id", text: str = "text",
                 bucket_bytes: int = BUCKET_BYTES, name: str = "shards") -> DataFrame:
    """Write all rows into ``shards`` shards and return the written table: ``doc_id,
    text, slot long, shard int`` (one folder per shard).

    Null texts count as empty for their size and stay null.  Rows that are equal
    in key and text may change places without a trace; copies that fill more than a quarter
    of a bucket are counted and dealt over the buckets, fewer share one.
    An empty table gives an empty result.  Other columns are not written.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    n = max(int(total) // bucket_bytes + 1, shards)
    single, copies, written_for = _many_copies(rows, max(1, bucket_bytes // 4))
    bucket = lambda *key: F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", *key), F.lit(n)).cast("int").alias("bucket")
    dealt = single.select("doc_id", "text", bucket()).unionByName(copies.select("doc_id", "text", bucket("copy")))
    counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.stage(counts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")), "offsets")

    def run(bucket: tuple, table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]).to_numpy()
        order = order[_fisher_yates(len(order), seed, bucket[0].as_py())]
        return table.select(["bucket", "doc_id", "text"]).take(pa.array(order)).append_column("pos", pa.array(np.arange(len(order))))

    # Partitions follow the buckets, however many shuffle partitions the session has.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKETS_PER_TASK))
    shuffled = dealt.repartition(parts, "bucket").groupBy("bucket").applyInArrow(run, "bucket int, doc_id long, text string, pos long")
    g = F.col("offset") + F.col("pos")
    placed = (shuffled.join(offsets, "bucket")
              .select("doc_id", "text", F.floor(g / shards).cast("long").alias("slot"), F.pmod(g, F.lit(shards)).cast("int").alias("shard")))
    written = scratch.stage(placed, name, "shard")
    scratch.discard(offsets, *written_for)
    return written
