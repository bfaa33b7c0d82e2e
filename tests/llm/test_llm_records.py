"""Operators 7, 8 and 10 against brute force."""

import random
import time
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lodestar.llm import perspectives, revisits, twopass

# --- revisits ------------------------------------------------------------------


def test_canonical_url(spark):
    urls = {
        "HTTPS://WWW.Example.com:443/a/b/?utm_source=x#frag": "example.com/a/b",
        "http://user@example.com:80/a?utm_a=1&page=2&utm_b=2&ref=x": "example.com/a?page=2&ref=x",
        "example.com": "example.com", "http://example.com/A.html": "example.com/A.html",
        " https://example.com/x//": "example.com/x", "http://example.com/?a=1&": "example.com/?a=1"}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == urls


def brute_resolve(rows):
    out = []
    for rid, kind, url, ts, headers in rows:
        if kind != "revisit":
            continue
        headers = headers or {}
        before = [(r[3], r[0], r[4] or {}) for r in rows if r[1] == "response" and r[2] == url and url is not None and ts is not None
                  and r[3] is not None and (r[3], r[0]) < (ts, rid)]
        outcome, base = "no earlier response", None
        if before:
            _, base, stored = max(before, key=lambda x: x[:2])
            strip = lambda t: t.removeprefix("W/")
            if "etag" in headers and "etag" in stored:
                agree = strip(headers["etag"]) == strip(stored["etag"])
            elif "last-modified" in headers and "last-modified" in stored:
                agree = headers["last-modified"] == stored["last-modified"]
            else:
                agree = None
            outcome = "no validator" if agree is None else "resolved" if agree else "changed"
            if agree:
                headers = {**stored, **{k: v for k, v in headers.items() if k not in revisits.NOT_MERGED}}
        out.append((rid, outcome, base if outcome == "resolved" else None, tuple(sorted(headers.items()))))
    return sorted(out, key=repr)


def test_resolve_equals_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        headers = {k: rnd.choice(v) for k, v in {"etag": ['"a"', 'W/"a"', '"b"'], "last-modified": ["d1", "d2"], "content-length": ["0", "9"],
                                                 "cache-control": ["x", "y"], "connection": ["close"]}.items() if rnd.random() < 0.6}
        rows.append((f"r{i}", rnd.choice(["response", "revisit", "revisit", "metadata"]),
                     "example.com/hot" if i % 3 else f"example.com/{rnd.randrange(20)}", rnd.randrange(200) * 1000, headers))
    rows += [("n1", "revisit", None, 5, {"etag": '"a"'}), ("n2", "revisit", "example.com/hot", None, None), ("n3", "response", None, 1, None),
             ("n4", "revisit", "example.com/never", 5, None)]
    df = spark.createDataFrame(rows, "record_id string, record_type string, url string, ts long, headers map<string,string>")
    df = df.withColumn("bucket", F.lit("clash")).withColumn("outcome", F.lit(0))
    for seconds in (1000, 7000, 10 ** 9):
        got = [(r.record_id, r.outcome, r.refers_to, tuple(sorted(r.headers.items()))) for r in revisits.resolve(df, seconds).collect()]
        assert sorted(got, key=repr) == brute_resolve(rows)
    assert revisits.resolve(df.limit(0)).count() == 0


def test_repeated_records_and_header_lines(spark):
    rows = [("a", "response", "x.org/", 1, {"etag": "1"}), ("b", "revisit", "x.org", 2, {"etag": "1"}), ("b", "revisit", "x.org", 2, {"etag": "1"})]
    df = spark.createDataFrame(rows, "record_id string, record_type string, url string, ts long, headers map<string,string>")
    got = revisits.resolve(df).select("refers_to", revisits.header_lines(F.col("headers")).alias("h")).collect()
    assert [tuple(r) for r in got] == [("a", "etag: 1")] * 2


# --- shards ----------------------------------------------------------------------

def test_two_pass_shuffle(spark):
    rows = [(i, None if i % 50 == 0 else "" if i % 51 == 0 else f"text {i} " * (i % 9)) for i in range(2000)]
    rows += [(5, "repeated")] * 3 + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("pos", F.lit(1))
    got = twopass.write_shards(df.repartition(7), shards=24, seed=3, bucket_bytes=4000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    shards = {s: sorted(r.slot for r in got if r.shard == s) for s in range(24)}
    assert all(slots == list(range(len(slots))) for slots in shards.values())
    counts = [len(x) for x in shards.values()]
    assert max(counts) - min(counts) <= 1
    again = twopass.write_shards(df.repartition(3), shards=24, seed=3, bucket_bytes=4000).collect()
    assert Counter(again) == Counter(got)                  # the same whatever the partitions
    other = twopass.write_shards(df, shards=24, seed=4, bucket_bytes=4000).collect()
    place = lambda rs: {r.doc_id: (r.shard, r.slot) for r in rs}
    a, b = place(got), place(other)
    assert sum(a[k] == b[k] for k in a) < 40
    # Neighbours by id land in unrelated shards.
    assert sum(a[i][0] == a[i + 1][0] for i in range(1999)) < 200
    assert twopass.write_shards(df.limit(0)).count() == 0


def test_copies_of_a_row_are_dealt_over_the_buckets(spark):
    rows = [(i, f"text {i}") for i in range(600)] + [(7, "hot " * 30)] * 300 + [(None, None)] * 500 + [(8, "twice")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = twopass.write_shards(df.repartition(6), shards=5, seed=2, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert sorted(r.slot * 5 + r.shard for r in got) == list(range(len(rows)))
    for key in (7, None):       # copies lie all over the order, not beside each other
        at = sorted(r.slot * 5 + r.shard for r in got if r.doc_id == key and r.text != "text 7")
        assert max(b - a for a, b in zip(at, at[1:], strict=False)) < 150 and at[-1] - at[0] > 1000
    again = twopass.write_shards(df.repartition(2), shards=5, seed=2, bucket_bytes=2000).collect()
    assert Counter(again) == Counter(got)


def test_checksum_is_of_utf8(spark):
    df = spark.createDataFrame([("é中",), ("",)], "t string").select(F.crc32(F.encode("t", "utf-8")).alias("c"), "t")
    assert all(r.c == zlib.crc32(r.t.encode()) for r in df.collect())


# --- perspectives ----------------------------------------------------------------

def brute_rotate(rows, part_turns):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        for who in {r[2] for r in mine if r[2] not in (None, "system")}:
            at = 0
            for part in sorted({(r[1] or 0) // part_turns for r in mine}):
                start, text, masks, n = at, "", [], 0
                for _, turn, role, said in mine:
                    if (turn or 0) // part_turns != part:
                        continue
                    n += 1
                    head = "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == who else f"<|user name={role or 'unknown'}|>\n"
                    body = (said or "") + "<|end|>"
                    if role == who:
                        masks.append((len(text) + len(head), len(text) + len(head) + len(body)))
                    text += head + body + "\n"
                at += len(text)
                out.append((conv, who, part, n, start, text, tuple(masks)))
    return sorted(out, key=repr)


def test_rotation_equals_brute_force(spark):
    rnd = random.Random(11)
    rows = [(c, t, rnd.choice(["user", "assistant", "critic", "system"]), rnd.choice(["hi", "é 中", "", None, "long " * 500]))
            for c in range(12) for t in range(rnd.randint(1, 9))]
    rows += [(99, t, "user" if t % 2 else "guest", f"turn {t}") for t in range(150)]
    rows += [(100, 0, "system", "only system"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (101, None, None, None), (101, 1, "user", "z"),
             (102, 0, "user", "same"), (102, 0, "user", "same"), (102, 0, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash")).withColumn("masks", F.lit(0))
    for part_turns in (4, 256):
        got = [(r.conv_id, r.participant, r.part, r.n_turns, r.char_start, r.text, tuple((m.start, m.end) for m in r.masks))
               for r in perspectives.rotate(df, part_turns).collect()]
        assert sorted(got, key=repr) == brute_rotate(rows, part_turns)
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_rotation_of_null_and_repeated_turns(spark):
    rnd = random.Random(12)
    rows = [(rnd.choice([None, None, 1]), rnd.choice([None, 0, 1, 3, 9]), rnd.choice(["user", "assistant", "système", "system", None]),
             rnd.choice(["hi", "é 中", None, "said"])) for _ in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = [(r.conv_id, r.participant, r.part, r.n_turns, r.char_start, r.text, tuple((m.start, m.end) for m in r.masks))
           for r in perspectives.rotate(df, 4).collect()]
    assert sorted(got, key=repr) == brute_rotate(rows, 4)


def test_work_of_a_part_is_linear(spark):
    took = {}
    for n in (2_000, 2_000, 48_000):
        df = spark.range(n).selectExpr("cast(null as long) as conv_id", "id % 8 as turn", "'user' as role", "'said' as text")
        began = time.monotonic()
        row = perspectives.rotate(df).selectExpr("n_turns", "size(masks) as n_masks").first()
        took[n] = time.monotonic() - began
        assert row.n_turns == row.n_masks == n
    assert took[48_000] < 24 * took[2_000]


def test_masks_cover_what_the_assistant_says(spark):
    df = spark.createDataFrame([(1, 0, "ann", "Hello"), (1, 1, "bob", "Hi Ann"), (1, 2, "ann", "Bye")], "conv_id long, turn long, role string, text string")
    got = {r.participant: r for r in perspectives.rotate(df).collect()}
    said = {who: [r.text[m.start: m.end] for m in r.masks] for who, r in got.items()}
    assert said == {"ann": ["Hello<|end|>", "Bye<|end|>"], "bob": ["Hi Ann<|end|>"]}
    assert "<|user name=bob|>\nHi Ann<|end|>" in got["ann"].text
