"""Table loading and the views derived from the driver tables.

Only the columns an operator needs are selected right after the scan, so the
parquet reader prunes the rest (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Typed trip records: taxi = supplier, driver = part, seconds = quantity
    minutes, amount = extended price."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("taxi_id"),
        F.col("l_partkey").cast("string").alias("driver_id"),
        (F.col("l_quantity") * 60.0).alias("trip_secs"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def trip_lines(lineitem: DataFrame, damaged: bool = True) -> DataFrame:
    """Seventeen comma-separated fields per line in the taxi layout, one line
    per lineitem row (input of the line parser P1-P5).  With ``damaged``, copies of some
    lines stand beside them in a malformed state: of order keys divisible by 97 one without
    the last field, of those divisible by 89 one with text for the fare."""
    ts_fmt = "yyyy-MM-dd HH:mm:ss"
    start = F.col("l_shipdate")
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
    fields = [
        F.col("l_suppkey"),                                   # 0 taxi
        F.col("l_partkey"),                                   # 1 driver
        F.date_format(start, ts_fmt),                         # 2 start
        F.date_format(end, ts_fmt),                           # 3 end
        F.col("l_quantity") * 60.0,                           # 4 seconds
        F.col("l_discount") * 100.0,                          # 5 distance
        F.col("l_orderkey"), F.col("l_linenumber"),           # 6, 7
        F.col("l_returnflag"), F.col("l_linestatus"),         # 8, 9
        F.lit("x"),                                           # 10
        F.col("l_extendedprice"),                             # 11 fare
        F.col("l_tax") * 10.0,                                # 12 surcharge
        F.lit("y"), F.lit("z"), F.lit("w"),                   # 13-15
        F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),  # 16 total
    ]
    text = [f.cast("string") for f in fields]
    whole = F.concat_ws(",", *text)
    if not damaged:
        return lineitem.select(whole.alias("value"))
    # Made beside the whole line in one pass over the rows.
    lines = F.array(whole, F.when(F.col("l_orderkey") % 97 == 0, F.concat_ws(",", *text[:-1])),
                    F.when(F.col("l_orderkey") % 89 == 0, F.concat_ws(",", *text[:11], F.lit("n/a"), *text[12:])))
    return lineitem.select(F.explode(F.array_compact(lines)).alias("value"))


def hourly_trips(events: DataFrame) -> DataFrame:
    """Trips for the best-hour analysis: start = ts, end = ts + 37*(event_id%5)
    minutes, surcharge = value, distance = user_id % 7 + 1."""
    return events.select(
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0),
                                          (F.pmod(F.col("event_id"), F.lit(5)) * 37).cast("int"))
         ).alias("end_ts"),
        (F.pmod(F.col("user_id"), F.lit(7)) + 1).cast("double").alias("distance"),
        F.col("value").alias("surcharge"),
    )


def tagged_lines(documents: DataFrame, id_expr=None) -> DataFrame:
    """One ``<doc id="..." url="..." title="...">text</doc>`` line per document."""
    doc_id = (id_expr if id_expr is not None else F.col("doc_id")).cast("string")
    return documents.select(F.concat(
        F.lit('<doc id="'), doc_id, F.lit('" url="http://docs/'),
        F.col("doc_id").cast("string"), F.lit('" title="'), F.col("source"),
        F.lit('">'), F.col("text"), F.lit("</doc>")).alias("value"))


# Fixed value: 14-character id prefix dropped by the grouped-id parse.
GROUP_ID_PREFIX = "lodestar-docs-"


def grouped_tagged_lines(documents: DataFrame) -> DataFrame:
    """Tagged lines whose id reads ``<14 chars>source/doc_id`` (S8 input)."""
    return tagged_lines(documents, F.concat(F.lit(GROUP_ID_PREFIX), F.col("source"),
                                            F.lit("/"), F.col("doc_id").cast("string")))
