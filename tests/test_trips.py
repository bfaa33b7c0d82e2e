import datetime as dt

from pyspark.sql import functions as F

from lodestar.operators import trips as TR


def _line(taxi, driver, start, end, secs, dist, fare, surcharge, total):
    f = [taxi, driver, start, end, secs, dist, "a", "b", "c", "d", "e", fare, surcharge, "f", "g", "h", total]
    return ",".join(str(v) for v in f)


def test_split_arity_and_numeric_checks(spark):
    lines = spark.createDataFrame([
        (_line("t1", "d1", "2013-01-01 10:50:00", "2013-01-01 11:10:00", 1200, 2.0, 10, 0.5, 12) + "\n",),
        ("too,few,fields",),
        (_line("t2", "d2", "2013-01-01 10:00:00", "2013-01-01 10:10:00", "x", 1.0, 5, 0.5, 6),),
    ], "value string")
    split = TR.split_lines(lines)
    assert split.count() == 2
    ok = split.filter(TR.numeric_ok(F.col("f"), [4, 5, 11, 12, 16]))
    trips = TR.typed_trips(ok).collect()
    assert [t.taxi_id for t in trips] == ["t1"]
    assert trips[0].start_ts == dt.datetime(2013, 1, 1, 10, 50)


def test_earnings_zero_filters_and_minutes(spark):
    trips = spark.createDataFrame([
        ("d1", 120.0, 10.0), ("d1", 0.0, 5.0), ("d1", 60.0, 0.0),   # zero secs keeps money, zero money keeps secs
        ("d2", 0.0, 7.0),                                          # no minutes -> dropped
        ("d3", 30.0, 3.0),                                         # single trip: secs / 60
    ], "driver_id string, trip_secs double, total_amount double")
    got = {r.driver_id: r.per_minute for r in TR.earnings_per_minute(trips).collect()}
    assert got == {"d1": 15.0 / 3.0, "d3": 3.0 / 0.5}


def test_touched_hours_not_snapped(spark):
    ts = dt.datetime
    trips = spark.createDataFrame([
        (ts(2013, 1, 1, 10, 50), ts(2013, 1, 1, 11, 10), 1.0, 1.0),   # only 10:50 -> hour 10
        (ts(2013, 1, 1, 23, 30), ts(2013, 1, 2, 1, 40), 1.0, 1.0),    # 23:30, 00:30, 01:30
        (ts(2013, 1, 1, 12, 0), ts(2013, 1, 1, 11, 0), 1.0, 1.0),     # reversed -> nothing
    ], "start_ts timestamp_ntz, end_ts timestamp_ntz, distance double, surcharge double")
    hours = sorted((str(r.day), r.hour) for r in TR.touched_hours(trips).collect())
    assert hours == [("2013-01-01", 10), ("2013-01-01", 23), ("2013-01-02", 0), ("2013-01-02", 1)]


def test_best_hour_ties_take_larger_hour_and_zero_distance_dropped(spark):
    d = dt.date(2013, 1, 4)
    hours = spark.createDataFrame([
        (d, 10, 2.0, 1.0), (d, 11, 4.0, 2.0), (d, 12, 0.0, 5.0),
    ], "day date, hour int, distance double, surcharge double")
    best = TR.best_hour(TR.hour_ratios(hours)).collect()
    assert [(r.day, r.ratio, r.hour) for r in best] == [(d, 0.5, 11)]


def test_trips_per_taxi_and_distinct_drivers(spark):
    trips = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b"), ("u", "a")], "taxi_id string, driver_id string")
    assert {r.taxi_id: r.n_trips for r in TR.trips_per_taxi(trips).collect()} == {"t": 3, "u": 1}
    assert {r.taxi_id: r.n_drivers for r in TR.drivers_per_taxi(trips).collect()} == {"t": 2, "u": 1}
    approx = {r.taxi_id: r.n_drivers for r in TR.drivers_per_taxi(trips, approx=True).collect()}
    assert approx == {"t": 2, "u": 1}


def test_damaged_copies_stand_beside_every_row(spark):
    from lodestar.sources.tables import table, trip_lines
    li = table(spark, "/root/testdata/sf0.001", "lineitem")
    whole, every = trip_lines(li, damaged=False), trip_lines(li)
    n = li.where("l_orderkey % 97 = 0").count() + li.where("l_orderkey % 89 = 0").count()
    assert n and every.count() == li.count() + n
    assert whole.exceptAll(every).count() == 0
    split = TR.split_lines(every)
    assert split.filter(TR.numeric_ok(F.col("f"), [4, 5, 11, 12, 16])).count() == li.count()


def test_sketches_unite_over_periods(spark):
    rows = [(f"t{i % 3}", f"d{(i * 7919) % 9000}", i % 12) for i in range(30_000)] + [("t9", None, 1)]
    trips = spark.createDataFrame(rows, "taxi_id string, driver_id string, month int")
    kept = TR.driver_sketches(trips, ["taxi_id", "month"])
    assert kept.count() == len({(t, m) for t, _, m in rows})
    told = {r.taxi_id: r.estimate for r in TR.united_drivers(kept, ["taxi_id"]).collect()}
    for t in ("t0", "t1", "t2"):
        exact = len({d for a, d, _ in rows if a == t})
        assert abs(told[t] - exact) <= TR.sketch_bound(12, 3) * exact
    assert told["t9"] == 0
    monthly = {(r.taxi_id, r.month): r.estimate for r in TR.united_drivers(kept, ["taxi_id", "month"]).collect()}
    assert abs(monthly["t1", 4] - len({d for a, d, m in rows if (a, m) == ("t1", 4)})) < 60
