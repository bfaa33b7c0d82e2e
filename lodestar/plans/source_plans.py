"""Registered source and sink queries: files written from the given tables into the shared
folder, read back through the readers, and compared whole."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.functions.numeric import significant
from lodestar.operators import textfeatures as TF
from lodestar.plans.registry import register
from lodestar.plans.sqlparts import sig, words_cte
from lodestar.session import ensure_checkpoint_dir
from lodestar.sources import readers, sinks
from lodestar.sources.tables import table, trip_lines

# Layout of a trip line (fixed by the line format).
TRIP_SCHEMA = ("taxi string, driver string, started timestamp, ended timestamp, secs double, distance double, f6 string, f7 string, "
               "f8 string, f9 string, f10 string, fare double, surcharge double, f13 string, f14 string, f15 string, total double")
HEADER_SCHEMA = "l_orderkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("delimited_sources", sql=f"""
WITH good AS (SELECT count(*) AS n, {sig('sum(l_quantity * 60.0)', 10)} AS secs, {sig('sum(l_extendedprice)', 10)} AS fare FROM lineitem),
bad AS (SELECT count(*) FILTER (WHERE l_orderkey % 97 = 0) + count(*) FILTER (WHERE l_orderkey % 89 = 0) AS n FROM lineitem)
SELECT 'bz2' AS source, good.n AS n_rows, CAST(bad.n AS BIGINT) AS n_rejected, secs, fare, '' AS types FROM good, bad
UNION ALL SELECT 'header', n, 0, secs, fare, '' FROM good
UNION ALL SELECT 'inferred', n, 0, secs, fare, 'int,double,double,string,timestamp' FROM good
""")
def delimited_sources(spark, sf):
    """Every trip line (with the damaged copies) as bz2 text, and columns of lineitem as CSV with a
    header, read back by schema with rejected lines, and with inferred types."""
    li = table(spark, sf, "lineitem")
    lines, headed = _folder(spark, "trip-lines"), _folder(spark, "lineitem-csv")
    trip_lines(li).write.option("compression", "bzip2").text(lines)
    li.select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate").write.option("header", True).csv(headed)

    def report(source, df, secs, fare, rejected, types=""):
        ok = rejected.isNull()
        return df.agg(F.lit(source).alias("source"), F.count_if(ok).alias("n_rows"), F.count(rejected).alias("n_rejected"),
                      significant(F.sum(F.when(ok, secs)), 10).alias("secs"), significant(F.sum(F.when(ok, fare)), 10).alias("fare"),
                      F.lit(types).alias("types"))

    trips = readers.delimited_checked(spark, lines, TRIP_SCHEMA)
    named = readers.delimited_checked(spark, headed, HEADER_SCHEMA, header=True)
    guessed = readers.delimited_inferred(spark, headed, header=True)
    none = F.lit(None).cast("string")
    secs, fare = F.col("l_quantity") * 60.0, F.col("l_extendedprice")
    return (report("bz2", trips, F.col("secs"), F.col("fare"), F.col("rejected"))
            .unionByName(report("header", named, secs, fare, F.col("rejected")))
            .unionByName(report("inferred", guessed, secs, fare, none, ",".join(t for _, t in guessed.dtypes))))


@register("range_ordered_lines", sql=f"""
SELECT l_returnflag, count(*) AS n_rows, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(0 AS BIGINT) AS n_disorder
FROM lineitem GROUP BY l_returnflag
""")
def range_ordered_lines(spark, sf):
    """K3/K4: lineitem written in key ranges with a manifest, read back against it; rows out of the
    global order (inside a part; parts by the manifest) would show as disorder."""
    path = _folder(spark, "ranges")
    sinks.write_ranges(table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"), path, "l_orderkey", "l_linenumber")
    back = sinks.read_ranges(spark, path, "l_orderkey", "l_linenumber").withColumn("place", F.monotonically_increasing_id())
    key = F.struct("l_orderkey", "l_linenumber")
    before = F.lag(key).over(Window.partitionBy("part").orderBy("place"))
    return (back.withColumn("disorder", F.coalesce(before > key, F.lit(False))).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"), F.count_if("disorder").alias("n_disorder")))


@register("line_word_count", sql=f"""
WITH {words_cte('documents')} SELECT word, count(*) AS n FROM words GROUP BY word
""")
def line_word_count(spark, sf):
    """All texts written as text lines and read back line by line; a text of several lines becomes as
    many, no word is cut."""
    path = _folder(spark, "lines")
    sinks.write_text(table(spark, sf, "documents", "text").where("text is not null"), path)
    lines = readers.text_lines(spark, path).select(F.monotonically_increasing_id().alias("line"), "value")
    return TF.word_counts(TF.tokenize(lines, "line", "value"))
