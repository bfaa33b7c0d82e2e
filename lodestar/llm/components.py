"""Connected components of a distributed edge list (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("v").cast("decimal(38,0)")),
                           F.sum(F.hash("v", "u").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(vertex, component)`` of every vertex with an
    edge; a component is named by its smallest vertex.  Self loops and repeated
    edges are harmless.  Every round hangs each vertex on a smaller one and is
    written to the shared folder; the number of rounds grows with the logarithm
    of the longest chain."""
    e = scratch.stage(edges.where("u <> v").select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u"))
                      .distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select("v", F.col("m").alias("u")).where("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .unionByName(low.select("v", F.col("m").alias("u")))).where("u <> v").distinct()
        before, e = e, scratch.stage(small, "edges")
        now = _state(e)
        scratch.discard(before)
        if now == state:
            break
        state = now
    # Converged: every vertex but the smallest of its component hangs on it.
    return (e.select(F.col("v").alias("vertex"), F.col("u").alias("component"))
            .unionByName(e.select(F.col("u").alias("vertex"), F.col("u").alias("component"))).distinct())
