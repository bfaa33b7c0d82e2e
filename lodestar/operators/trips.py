"""Trip analytics: line parsing (P1-P7), per-taxi and per-driver aggregates
(A1-A4, J3, T1, T2) and the best hour per day (A5-A7, U1).

All aggregates are hash aggregates with map-side partial aggregation, so a
taxi or driver holding a large share of the rows is combined per task before
the shuffle.  Per-driver minutes and money come from one conditional
aggregation instead of a self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.numeric import safe_ratio, to_double

ARITY = 17
# Fixed value: timestamp layout of the trip records.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIE_DIGITS = 9  # ratios equal to 9 decimals count as ties


def split_lines(lines: DataFrame, value_col: str = "value", arity: int = ARITY) -> DataFrame:
    """P1 + P2: strip a trailing newline, split on commas, keep lines with
    exactly ``arity`` fields.  Result column ``f`` is the field array.  The
    array passes through a one-element ``explode``: a generator's output is a
    value, so the split is not evaluated again for every field."""
    fields = F.split(F.regexp_replace(F.col(value_col), r"\n$", ""), ",", -1)
    return lines.select(F.explode(F.array(fields)).alias("f")).filter(F.size("f") == arity)


def numeric_ok(fields: Column, idx: list[int]) -> Column:
    """All listed fields parse as doubles."""
    cond = F.lit(True)
    for i in idx:
        cond = cond & to_double(fields[i]).isNotNull()
    return cond


def nonzero(fields: Column, idx: list[int]) -> Column:
    """All listed fields are non-zero numbers."""
    cond = F.lit(True)
    for i in idx:
        cond = cond & (to_double(fields[i]) != 0)
    return cond


def typed_trips(split: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Name and type the fields the analyses read."""
    f = F.col("f")
    return split.select(
        *keep,
        f[0].alias("taxi_id"), f[1].alias("driver_id"),
        F.to_timestamp_ntz(f[2], F.lit(TS_FORMAT)).alias("start_ts"),
        F.to_timestamp_ntz(f[3], F.lit(TS_FORMAT)).alias("end_ts"),
        to_double(f[4]).alias("trip_secs"), to_double(f[5]).alias("distance"),
        to_double(f[11]).alias("fare"), to_double(f[12]).alias("surcharge"),
        to_double(f[16]).alias("total_amount"))


def trips_per_taxi(trips: DataFrame) -> DataFrame:
    """A1: trip rows per taxi (what the stored per-taxi counts hold)."""
    return trips.groupBy("taxi_id").agg(F.count(F.lit(1)).alias("n_trips"))


def drivers_per_taxi(trips: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A2: distinct drivers per taxi; ``approx`` uses HyperLogLog++ (no
    per-group distinct set, constant memory per taxi)."""
    agg = (F.approx_count_distinct("driver_id", rsd) if approx
           else F.countDistinct("driver_id"))
    return trips.groupBy("taxi_id").agg(agg.alias("n_drivers"))


def earnings_per_minute(trips: DataFrame) -> DataFrame:
    """Money per driving minute per driver.

    Zero-second trips are left out of the minutes and zero-amount trips out of
    the money (the reference's pairwise zero filters); a driver needs both a
    non-zero total of minutes and of money.  Minutes are ``sum(secs) / 60``.
    """
    secs = F.sum(F.when(F.col("trip_secs") != 0, F.col("trip_secs")))
    money = F.sum(F.when(F.col("total_amount") != 0, F.col("total_amount")))
    per = trips.groupBy("driver_id").agg(secs.alias("secs"), money.alias("money"))
    return (per.filter((F.col("secs") != 0) & (F.col("money") != 0))
            .select("driver_id", (F.col("secs") / 60.0).alias("minutes"), "money",
                    (F.col("money") / (F.col("secs") / 60.0)).alias("per_minute")))


def touched_hours(trips: DataFrame) -> DataFrame:
    """One row per hour step from the start time to the end time
    (inclusive, not snapped to the hour); each row carries the whole distance
    and surcharge.  Trips ending before they start touch no hour."""
    steps = F.sequence(F.col("start_ts"), F.col("end_ts"), F.expr("INTERVAL 1 HOUR"))
    return (trips.filter(F.col("start_ts") <= F.col("end_ts"))
            .select(F.explode(steps).alias("t"), "distance", "surcharge")
            .select(F.to_date("t").alias("day"), F.hour("t").alias("hour"), "distance", "surcharge"))


def start_hours(trips: DataFrame) -> DataFrame:
    """F8: the start hour only."""
    return trips.select(F.to_date("start_ts").alias("day"), F.hour("start_ts").alias("hour"),
                        "distance", "surcharge")


def hour_ratios(hours: DataFrame) -> DataFrame:
    """Surcharge per distance for each (day, hour); zero distance -> dropped."""
    sums = hours.groupBy("day", "hour").agg(F.sum("distance").alias("distance"),
                                            F.sum("surcharge").alias("surcharge"))
    return (sums.select("day", "hour", safe_ratio("surcharge", "distance").alias("ratio"))
            .filter(F.col("ratio").isNotNull()))


def best_hour(ratios: DataFrame) -> DataFrame:
    """Per day the hour with the largest ratio, ties -> larger hour.
    ``max(struct)`` is lexicographic and partially aggregated per task."""
    best = F.max(F.struct(F.round("ratio", TIE_DIGITS).alias("r"), F.col("hour").alias("h"),
                          F.col("ratio").alias("ratio")))
    return (ratios.groupBy("day").agg(best.alias("b"))
            .select("day", F.col("b.ratio").alias("ratio"), F.col("b.h").alias("hour")))


# ---------------------------------------------------------------- A2, approximate

def driver_sketches(trips: DataFrame, keys: list[str], lg: int = 12) -> DataFrame:
    """A2's sketch table: per key (a period may be one of them) a mergeable sketch of the distinct
    drivers, ``2^lg`` registers at most; its size doesn't grow with the trips."""
    return trips.groupBy(*keys).agg(F.hll_sketch_agg("driver_id", lg).alias("sketch"))


def united_drivers(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches united over what is not in ``keys``: ``(keys, estimate)`` without reading a trip."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def sketch_bound(lg: int, sigmas: float) -> float:
    """Relative error of united sketches at so many standard errors (1.04 / sqrt(2^lg))."""
    return sigmas * 1.04 / 2 ** (lg / 2)
