"""Checked and inferred delimited sources, range-ordered writes."""

import os
import shutil
import tempfile

import pytest

from lodestar.sources import readers, sinks


def _write(spark, lines, **options):
    where = os.path.join(tempfile.mkdtemp(prefix="lodestar-src-"), "files")
    writer = spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.text(where)
    return where


def test_rejected_lines_keep_their_text(spark):
    lines = ["1,2.5,a", "2,x,b", "3,1.0", "4,1.0,d,e", ",,", "5,7,z"]
    got = readers.delimited_checked(spark, _write(spark, lines, compression="bzip2"), "k int, v double, w string")
    rows = {(r.k, r.w): r for r in got.collect()}
    assert {r.rejected for r in rows.values() if r.rejected} == {"2,x,b", "3,1.0", "4,1.0,d,e"}
    assert rows[1, "a"].v == 2.5 and rows[5, "z"].v == 7.0 and rows[None, None].rejected is None
    # The count is the same whatever columns are read.
    assert len(got.where("rejected is not null").select("k").collect()) == 3


def test_bz2_is_read_in_splits(spark):
    import random
    rnd = random.Random(1)
    lines = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(80)) for _ in range(40_000)]
    where = os.path.join(tempfile.mkdtemp(prefix="lodestar-src-"), "one")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("compression", "bzip2").text(where)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
    try:
        df = readers.text_lines(spark, where)
        assert df.rdd.getNumPartitions() > 2
        assert sorted(r.value for r in df.collect()) == sorted(lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_types_are_inferred_over_all_rows(spark):
    lines = ["1,3000000000,1.5,2020-01-02,2020-01-02 03:04:05,true,"] * 300 + ["2,1,2,2021-05-06,2020-01-02,false,"]
    got = readers.delimited_inferred(spark, _write(spark, lines))
    assert [t for _, t in got.dtypes] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string"]
    mixed = readers.delimited_inferred(spark, _write(spark, [*lines, "x,1,1,1,1,1,1"]))
    assert [t for _, t in mixed.dtypes][:2] == ["string", "bigint"]
    assert mixed.count() == 302


def test_ranges_follow_their_manifest(spark):
    where = os.path.join(tempfile.mkdtemp(prefix="lodestar-sink-"), "ranges")
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 as k", "id as v").union(spark.sql("select cast(null as long) k, 1L v"))
    sinks.write_ranges(df.repartition(6), where, "k", "v", parts=6)
    back = sinks.read_ranges(spark, where, "k", "v")
    assert back.count() == 5001
    bounds = sorted((r.part, r.low.k, r.high.k) for r in spark.read.parquet(f"{where}-manifest").where("low.k is not null").collect())
    assert len(bounds) > 3 and all(a[2] <= b[1] for a, b in zip(bounds, bounds[1:]))
    with pytest.raises(Exception, match="already exists"):
        sinks.write_ranges(df, where, "k")
    # A part that goes missing, or grows, is told.
    copy = os.path.join(tempfile.mkdtemp(prefix="lodestar-sink-"), "ranges")
    shutil.copytree(f"{where}-manifest", f"{copy}-manifest")
    back.where("part <> 2").write.partitionBy("part").parquet(copy)
    with pytest.raises(sinks.BrokenRanges, match="part 2 differs"):
        sinks.read_ranges(spark, copy, "k", "v")


def test_ranges_of_an_empty_table(spark):
    where = os.path.join(tempfile.mkdtemp(prefix="lodestar-sink-"), "none")
    sinks.write_ranges(spark.range(10), where, "id")
    assert sinks.read_ranges(spark, where, "id").count() == 10


def test_one_hot_ranges_and_unseen_values(spark):
    from lodestar.operators import tabular as TB
    rows = [(1, 2.0, "a", ["x", "y", "x"]), (2, None, "b", []), (3, 1.0, "a", ["y"]), (4, 5.0, None, None)]
    train = spark.createDataFrame(rows, "k int, n double, c string, t array<string>")
    fitted = TB.fit_one_hot(train, "k", ["n"], ["c", "t"])
    assert {(r.col, r.value): r.pos for r in fitted.table.collect()} == {("c", "a"): 1, ("c", "b"): 2, ("t", "y"): 4, ("t", "x"): 5}
    assert fitted.unseen == {"c": 3, "t": 6} and fitted.width == 7
    new = spark.createDataFrame([(7, 1.5, "zz", ["q", "r", "x", None]), (8, None, "b", None)], train.schema)
    got = {r.k: (r.pos, r.x) for r in TB.encode_one_hot(train.union(new), "k", fitted).collect()}
    assert got == {1: ([0, 1, 4, 5], [2.0, 1.0, 1.0, 1.0]), 2: ([2], [1.0]), 3: ([0, 1, 4], [1.0, 1.0, 1.0]),
                   4: ([0, 3], [5.0, 1.0]), 7: ([0, 3, 5, 6], [1.5, 1.0, 1.0, 1.0]), 8: ([2], [1.0])}
    none = TB.fit_one_hot(train.limit(0), "k", [], ["c"])
    assert none.width == 1 and {tuple(r.pos) for r in TB.encode_one_hot(train, "k", none).collect()} == {(0,)}


def test_assembled_vectors(spark):
    from lodestar.operators import tabular as TB
    df = spark.createDataFrame([(1, 2.0, [0, 2]), (2, 3.0, [])], "k int, n double, p array<int>")
    got = {r.k: r.features.toArray().tolist() for r in TB.assembled(df, ["n"], "p", 3).collect()}
    assert got == {1: [2.0, 1.0, 0.0, 1.0], 2: [3.0, 0.0, 0.0, 0.0]}
