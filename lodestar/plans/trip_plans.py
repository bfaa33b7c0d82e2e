"""Registered trip queries over ``lineitem`` (taxi = supplier, driver = part)
and ``events`` (hourly surcharge per distance)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import trips as TR
from lodestar.plans.registry import DIGITS, register
from lodestar.session import staged
from lodestar.sources.tables import hourly_trips, table, trip_lines, trips_from_lineitem

TRIPS_SQL = """trips AS (SELECT CAST(l_suppkey AS VARCHAR) AS taxi_id, CAST(l_partkey AS VARCHAR) AS driver_id,
  l_quantity * 60.0 AS trip_secs, l_extendedprice AS total_amount FROM lineitem)"""

HOURLY_SQL = """ht AS (SELECT ts AS start_ts, ts + to_minutes(CAST((event_id % 5) * 37 AS BIGINT)) AS end_ts,
  CAST(user_id % 7 + 1 AS DOUBLE) AS distance, value AS surcharge FROM events)"""


def _trips(spark, sf):
    cols = ("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
    return trips_from_lineitem(table(spark, sf, "lineitem", *cols))


@register("trips_per_taxi", sql=f"""
WITH {TRIPS_SQL} SELECT taxi_id, count(*) AS n_trips FROM trips GROUP BY taxi_id
""")
def trips_per_taxi(spark, sf):
    return TR.trips_per_taxi(_trips(spark, sf))


@register("top10_taxis_by_trips", sql=f"""
WITH {TRIPS_SQL} SELECT taxi_id, count(*) AS n_trips FROM trips GROUP BY taxi_id
ORDER BY n_trips DESC, taxi_id LIMIT 10
""")
def top10_taxis_by_trips(spark, sf):
    return TR.trips_per_taxi(_trips(spark, sf)).orderBy(F.desc("n_trips"), "taxi_id").limit(10)


@register("top10_taxis_by_distinct_drivers", sql=f"""
WITH {TRIPS_SQL} SELECT taxi_id, count(DISTINCT driver_id) AS n_drivers FROM trips GROUP BY taxi_id
ORDER BY n_drivers DESC, taxi_id LIMIT 10
""")
def top10_taxis_by_distinct_drivers(spark, sf):
    return TR.drivers_per_taxi(_trips(spark, sf)).orderBy(F.desc("n_drivers"), "taxi_id").limit(10)


@register("top10_drivers_by_earnings_per_minute", sql=f"""
WITH {TRIPS_SQL},
per AS (SELECT driver_id, sum(CASE WHEN trip_secs <> 0 THEN trip_secs END) AS secs,
               sum(CASE WHEN total_amount <> 0 THEN total_amount END) AS money FROM trips GROUP BY driver_id),
e AS (SELECT driver_id, secs / 60.0 AS minutes, money, money / (secs / 60.0) AS per_minute
      FROM per WHERE secs <> 0 AND money <> 0)
SELECT driver_id, round(minutes, {DIGITS}) AS minutes, round(money, {DIGITS}) AS money,
       round(per_minute, {DIGITS}) AS per_minute
FROM e ORDER BY round(per_minute, 9) DESC, driver_id LIMIT 10
""")
def top10_drivers_by_earnings(spark, sf):
    e = TR.earnings_per_minute(_trips(spark, sf))
    top = e.orderBy(F.desc(F.round("per_minute", 9)), "driver_id").limit(10)
    return top.select("driver_id", *[F.round(c, DIGITS).alias(c) for c in ("minutes", "money", "per_minute")])


SKETCH_LG, SKETCH_SIGMAS = 12, 3


@register("driver_sketches", sql=f"""
WITH {TRIPS_SQL} SELECT taxi_id, count(DISTINCT driver_id) AS n_drivers, true AS within FROM trips GROUP BY taxi_id
""")
def driver_sketches(spark, sf):
    """A2, approximate variant: distinct-count sketches per taxi and month are kept as a table and
    united over the months; every estimate lies within the stated bound of the exact count."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_shipdate")
    trips = li.select(F.col("l_suppkey").cast("string").alias("taxi_id"), F.col("l_partkey").cast("string").alias("driver_id"),
                      F.trunc("l_shipdate", "month").alias("month"))
    kept = staged(TR.driver_sketches(trips, ["taxi_id", "month"], SKETCH_LG), "driver-sketches")
    told = TR.united_drivers(kept, ["taxi_id"])
    exact = TR.drivers_per_taxi(trips)
    bound = TR.sketch_bound(SKETCH_LG, SKETCH_SIGMAS)
    return exact.join(told, "taxi_id").select(
        "taxi_id", "n_drivers", (F.abs(F.col("estimate") - F.col("n_drivers")) <= F.greatest(F.lit(1.0), bound * F.col("n_drivers"))).alias("within"))


def _best_hour_sql(hours_sql: str) -> str:
    return f"""
WITH {HOURLY_SQL},
hours AS ({hours_sql}),
r AS (SELECT day, hour, sum(surcharge) / sum(distance) AS ratio FROM hours GROUP BY day, hour
      HAVING sum(distance) <> 0),
b AS (SELECT day, hour, ratio, row_number() OVER (PARTITION BY day ORDER BY round(ratio, 9) DESC, hour DESC) AS rn FROM r)
SELECT day, round(ratio, {DIGITS}) AS ratio, hour FROM b WHERE rn = 1
"""


@register("best_hour_by_start", sql=_best_hour_sql(
    "SELECT CAST(start_ts AS DATE) AS day, CAST(hour(start_ts) AS INTEGER) AS hour, distance, surcharge FROM ht"))
def best_hour_by_start(spark, sf):
    ht = hourly_trips(table(spark, sf, "events", "event_id", "ts", "user_id", "value"))
    b = TR.best_hour(TR.hour_ratios(TR.start_hours(ht)))
    return b.select("day", F.round("ratio", DIGITS).alias("ratio"), "hour")


@register("best_hour_spanning", sql=_best_hour_sql(
    "SELECT CAST(t AS DATE) AS day, CAST(hour(t) AS INTEGER) AS hour, distance, surcharge FROM "
    "(SELECT unnest(generate_series(start_ts, end_ts, INTERVAL 1 HOUR)) AS t, distance, surcharge FROM ht "
    "WHERE start_ts <= end_ts)"))
def best_hour_spanning(spark, sf):
    ht = hourly_trips(table(spark, sf, "events", "event_id", "ts", "user_id", "value"))
    b = TR.best_hour(TR.hour_ratios(TR.touched_hours(ht)))
    return b.select("day", F.round("ratio", DIGITS).alias("ratio"), "hour")


@register("trip_line_parse", sql=f"""
SELECT CAST(l_suppkey AS VARCHAR) AS taxi_id, count(*) AS n_lines,
       round(sum(l_quantity * 60.0), {DIGITS}) AS secs, round(sum(l_discount * 100.0), {DIGITS}) AS distance,
       round(sum(l_extendedprice), {DIGITS}) AS fare, round(sum(l_tax * 10.0), {DIGITS}) AS surcharge,
       count(*) FILTER (WHERE l_discount <> 0 AND l_extendedprice <> 0) AS n_regression_rows,
       min(date_trunc('second', l_shipdate)) AS first_start
FROM lineitem GROUP BY l_suppkey
""")
def trip_line_parse(spark, sf):
    """Lines -> fields -> typed trips, summarised per taxi; every
    row counts, and the damaged copies beside some of them (a missing field, a non-numeric one) drop out."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate")
    split = TR.split_lines(trip_lines(li))
    ok = (split.filter(TR.numeric_ok(F.col("f"), [4, 5, 11, 12, 16]))
          .withColumn("reg", TR.nonzero(F.col("f"), [5, 11])))
    trips = TR.typed_trips(ok, keep=("reg",))
    return trips.groupBy("taxi_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        *[F.round(F.sum(c), DIGITS).alias(a) for c, a in
          (("trip_secs", "secs"), ("distance", "distance"), ("fare", "fare"), ("surcharge", "surcharge"))],
        F.count_if("reg").alias("n_regression_rows"),
        F.min("start_ts").alias("first_start"))
