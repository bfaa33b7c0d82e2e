"""Operators 4, 5 and 9 against brute force."""

import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import fmindex, plans, tokengroups, vafile
from lodestar.llm.components import components

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_az(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- decontamination --------------------------------------------------------------

def brute_hits(docs, items, width):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower_az(t))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k: k + width]), set()).add(str(i))
    out = []
    for t in docs:
        w, hit, found = WORD.findall(lower_az(t)), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if k + n <= len(w) and (x := tuple(w[k: k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((len(w), len(hit), sorted(found)))
    return out


def random_texts(rnd, n, longest):
    alphabet = rnd.choice([["a", "b"], ["A", "b", "c", "é", "D1"], [f"w{i}" for i in range(30)]])
    make = lambda k: "".join(rnd.choice(alphabet) + rnd.choice([" ", "--", "\n", " . "]) for _ in range(k))
    return [make(rnd.randint(0, longest)) for _ in range(n)], make


@pytest.mark.parametrize("seed", range(60))
def test_index_finds_every_window(seed):
    rnd = random.Random(seed)
    docs, make = random_texts(rnd, rnd.randint(0, 12), 60)
    items = [(i % 7, make(rnd.randint(0, 14))) for i in range(rnd.randint(0, 9))] + [(99, None)]
    width = rnd.choice([1, 2, 3, 10])
    docs += [None, "", items[0][1] or "x"]
    p = fmindex.phrases_of([i for i, _ in items], [t for _, t in items], width)
    words, hit, found = fmindex._examine(bw.strings(pa.array(docs, pa.string())), p)
    got = zip(words.counts.tolist(), np.bincount(words.doc[hit], minlength=len(docs)).tolist(), map(sorted, found), strict=True)
    assert list(got) == brute_hits(docs, items, width)


def test_suffix_order():
    rnd = random.Random(0)
    for _ in range(50):
        text = np.array([rnd.randint(0, 3) for _ in range(rnd.randint(1, 60))] + [0])
        keys, seen = [], 0
        for c in text:
            keys.append((0, seen) if c == 0 else (1, c))
            seen += c == 0
        assert fmindex.suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: keys[i:])


def test_decontaminate_table(spark):
    long = " ".join(f"t{i}" for i in range(30))
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, ""),
                                   (5, long), (5, long)], "item_id long, text string")
    docs = [(1, "x ONE two; three four five six seven eight nine ten eleven y"), (2, None), (3, ""), (4, "a short ITEM, short item b"),
            (5, "clean text"), (5, "clean text"), (None, "é short item"), (6, f"{long} {long} " + "w " * 60_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("lang", F.lit("en"))
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.lang) for r in fmindex.decontaminate(df, items).collect()]
    want = brute_hits([t for _, t in docs], [(r.item_id, r.text) for r in items.collect()], 10)
    assert sorted(got, key=repr) == sorted([(i, *w, "en") for (i, _), w in zip(docs, want, strict=True)], key=repr)
    clean = {r.doc_id: r.text for r in fmindex.decontaminate(df, items, clean=True).collect()}
    assert clean[1] == "x \n y" and clean[2] is None and clean[4] == "a \n b" and clean[None] == "é \n"
    assert fmindex.decontaminate(df.limit(0), items).count() == 0
    assert {r.n_hit for r in fmindex.decontaminate(df, items.limit(0)).collect()} == {0}


def test_items_without_id_as_in_the_sql(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "a short item b"), (2, "other one"), (3, "clean"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "short item"), (None, "other"), ("", "short item"), ("1", "item b"), (None, "short item")],
                                  "item_id string, text string")
    for name, df in (("documents", docs), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r.doc_id: r["items"] for r in fmindex.decontaminate(docs, items).collect()}
    assert found == {1: ["", "1", None], 2: [None], 3: [], None: []}
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = db.execute(plans.ORACLE["op4_fm_decontaminate"]).fetchall()
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", 12)
    got = [tuple(r) for r in plans.QUERIES["op4_fm_decontaminate"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_cleaning_leaves_no_seam(spark):
    items = spark.createDataFrame([(1, "a b"), (2, "c d")], "item_id long, text string")
    df = spark.createDataFrame([(1, "a c d b x")], "doc_id long, text string")
    assert fmindex.decontaminate(df, items, clean=True).first().text.split() == ["x"]


@pytest.mark.parametrize("clean", [False, True])
def test_blocks_of_phrases_equal_one_block(spark, monkeypatch, clean):
    rnd = random.Random(7)
    docs, make = random_texts(rnd, 25, 60)
    items = [(i % 9, make(rnd.randint(0, 30))) for i in range(20)] + [(None, make(12)), (99, None)]
    df = spark.createDataFrame([(i % 20, t, "x") for i, t in enumerate([*docs, None, "", docs[0]])], "doc_id long, text string, `row` string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = lambda found: sorted((tuple(r) for r in found.collect()), key=repr)
    one = key(fmindex.decontaminate(df, bench, width=3, clean=clean))
    assert any(r[4] for r in one)
    monkeypatch.setattr(fmindex, "PIECE_WORDS", 4)
    assert key(fmindex.decontaminate(df, bench, width=3, clean=clean)) == one
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", 300)
    assert key(fmindex.decontaminate(df, bench, width=3, clean=clean)) == one
    if not clean:
        want = brute_hits([r.text for r in df.collect()], items, 3)
        assert sorted((r[3], r[4], sorted(map(str, r[5]))) for r in one) == sorted(want)
    assert fmindex.decontaminate(df.limit(0), bench, width=3, clean=clean).collect() == []


# --- similarity join -----------------------------------------------------------------

def shingle_set(t):
    w = lower_az(t).encode().split()
    return frozenset([b" ".join(w)] if 0 < len(w) < 5 else [b" ".join(w[i: i + 5]) for i in range(len(w) - 4)])


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def near_copies(rnd, text, n, most):
    for _ in range(n):
        w = text.split()
        for _ in range(rnd.randint(0, most)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10 ** 6)}"
        yield " ".join(w)


def test_join_equals_brute_force(spark):
    rnd = random.Random(4)
    make = lambda n: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    passage, texts = make(40), []
    for n in (8, 20, 60, 150, 400):
        texts += list(near_copies(rnd, make(n), 25, max(1, n // 25)))
    texts += [f"{make(rnd.randint(5, 60))} {passage}" for _ in range(80)] + [passage] * 5
    texts += ["", "  \n", "one two", "One  TWO", "one two three four", "a b c d e", "A B C D E f", "x", "x"]
    texts += list(near_copies(rnd, passage, 30, 3))
    rnd.shuffle(texts)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash")).repartition(5)
    got = tokengroups.jaccard_components(df)
    assert sorted(tuple(r) for r in got.collect()) == brute_components(rows)


def test_join_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(tokengroups, "BLOCK_SETS", 7)
    rnd = random.Random(9)
    rows = list(enumerate(near_copies(rnd, " ".join(f"w{i}" for i in range(60)), 60, 4)))
    got = tokengroups.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute_components(rows)


def test_unrelated_short_texts_share_no_group(spark):
    rows = [(" ".join(f"w{i}x{j}" for j in range(5 + i % 12)),) for i in range(120)]
    frequent = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    parts = tokengroups.matrix_input(spark.createDataFrame(rows, "text string"), frequent, 4, 5, 3, 4)
    groups = tokengroups.form_groups(parts.where("kind = 0").selectExpr("a as band", "b as e")).collect()
    assert len(groups) == len({r.e for r in groups}) == len({r.g for r in groups}) == 120


def test_join_of_short_texts(spark):
    rnd = random.Random(14)
    rows = list(enumerate(" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) for _ in range(300)))
    texts = [t for i in range(12) for t in near_copies(rnd, " ".join(f"v{i}x{j}" for j in range(24)), 3, 1)]
    rows += [(1000 + i, t) for i, t in enumerate(texts)]
    got = tokengroups.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute_components(rows)


def test_join_rows_without_ids_and_ids_with_two_texts(spark):
    rnd = random.Random(3)
    base = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(6)]
    rows = [(None if rnd.random() < 0.4 else rnd.randint(0, 30), t) for b in base for t in near_copies(rnd, b, 12, 2)]
    rows += [(5, base[0]), (5, base[1]), (None, base[2]), (None, base[2]), (None, None), (7, " ".join(base * 60)), (8, " ".join(base * 60) + " end")]
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:                          # least row reachable
        for i in range(len(rows)):
            for j in range(len(rows)):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if all(label[label[i]] == label[i] for i in range(len(rows))):
            break
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[label[i]] = min(least.get(label[i], d), d)
    want = [(d, len(sets[i]), least.get(label[i]) if sets[i] else d) for i, (d, _) in enumerate(rows)]
    got = tokengroups.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted(want, key=repr)


def test_frequent_tokens_are_counted_over_all_sets(spark, monkeypatch):
    passage = " ".join(f"p{j}" for j in range(30))
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) + " " + passage for i in range(40)] + [passage] * 50
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = tokengroups.frequent_tokens(df, 90, 4, 5, 0, 1)       # a prefix that takes all hashes
    shared = next(s for _, s in tokengroups.batch_sets(pa.array([passage]), 5))
    assert set(got.tolist()) == set(shared.tolist())


def test_frequent_tokens_of_many_rows_are_counted_over_all_sets(spark):
    """However many rows there are, tokens of the higher hashes too, and the order is that of their exact numbers."""
    passages = [" ".join(f"p{k}x{j}" for j in range(40)) for k in range(3)]
    texts = [" ".join([f"w{i}x{j}" for j in range(20)] + [p for k, p in enumerate(passages) if i < 30 + 10 * k]) for i in range(50)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = tokengroups.frequent_tokens(df, 10 ** 9, 4, 5, 3, 4).tolist()
    own = [set(next(s for _, s in tokengroups.batch_sets(pa.array([p]), 5)).tolist()) for p in passages]
    assert max(own[0]) > 2 ** 63 and len(got) == len(set(got))
    at = [sorted(got.index(t) for t in s) for s in own]
    assert at[0][-1] < at[1][0] and at[1][-1] < at[2][0] and own[0] | own[1] | own[2] <= set(got)


def test_counted_tokens_are_packed_whole():
    for tokens in (np.array([5], np.uint64), np.array([0, 3, 2 ** 40, 2 ** 64 - 1], np.uint64)):
        assert tokengroups._unplaned(tokengroups._planes(tokens)).tolist() == tokens.tolist()


def test_join_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "alone in the world now"), (4, None)]
    got = tokengroups.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (None, 2, 3), (None, 1, None), (4, 0, 4)], key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokengroups.jaccard_components(empty).count() == 0


def test_prefix_bound_holds():
    """Sets at the threshold share as many prefix tokens as the matrix asks for."""
    rnd = random.Random(1)
    for _ in range(3000):
        n = rnd.randint(1, 60)
        m = rnd.randint(max(1, -(-3 * n // 4)), n)
        least = -(-3 * (n + m) // 7)
        if least > m:
            continue
        common = rnd.sample(range(1000), least)
        a = sorted(common + [1000 + x for x in rnd.sample(range(-900, 1000), n - least)])
        b = sorted(common + [5000 + x for x in rnd.sample(range(-5000, 0), m - least) if 5000 + x not in common])
        if len(set(a)) < n or len(set(b)) < m or set(a) & set(b) != set(common):
            continue
        c = len(set(a[: tokengroups._prefix(n, 3, 4)]) & set(b[: tokengroups._prefix(m, 3, 4)]))
        need = min(1 - math.ceil(3 * x / 4) + math.ceil(3 * (n + m) / 7) for x in (n, m))
        assert c >= max(1, need)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(500, 500), (7, 7)]
    label = {v: v for e in edges for v in e}
    for _ in range(200):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {v for u, v in edges if u != v} | {u for u, v in edges if u != v}
    assert got == {v: label[v] for v in linked}


# --- top-k search ----------------------------------------------------------------

def brute_top(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {q: a for q, a in ok if q % 50 == 0}.items():
        s = sorted({(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(b) == len(a)})
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rnd = random.Random(3)
    vector = lambda: [float(np.float32(rnd.gauss(0, 0.2))) for _ in range(8)]
    rows = [(i, vector()) for i in range(400)]
    hot = vector()
    rows += [(i, hot) for i in range(400, 700)]                     # ties: the smaller id first
    rows += [(701, None), (750, []), (702, [None] * 8), (800, [float("nan")] * 8), (703, [float("inf")] + hot[1:]), (None, hot),
             (850, [0.5, 0.5]), (851, [0.1, -0.7]), (900, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(6)
    got = vafile.top_k(df, df.where("vec_id % 50 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5)


def test_top_k_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vafile, "QUERY_BYTES", 200)
    rnd = random.Random(8)
    rows = [(i * 10, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in vafile.top_k(df, df.where("vec_id % 50 = 0")).collect()) == brute_top(rows, 5)
    assert vafile.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("split", ["one task", "many tasks", "query blocks"])
def test_top_k_of_repeated_rows_equals_its_sql(spark, tmp_path, monkeypatch, split):
    if split == "query blocks":
        monkeypatch.setattr(vafile, "QUERY_BYTES", 100)
    rnd = random.Random(5)
    vector = lambda: [float(np.float32(rnd.gauss(0, 0.3))) for _ in range(4)]
    rows = [(i, vector()) for i in range(1, 90)]
    near = [float(np.float32(x * 2)) for x in rows[49][1]]
    rows += [rows[49]] * 8 + [(100, vector())] * 3 + [(150, vector()), (150, vector())]     # repeated queries
    rows += [(1001, near)] * 2 + [(1002, near)] * 7 + [(50, near)] * 9 + [(1003, near)] + [rows[3]] * 6
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(1 if split == "one task" else 7)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = plans.QUERIES["op9_vector_approximation"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(tuple(r) for r in got) == sorted(con.execute(plans.ORACLE["op9_vector_approximation"]).fetchall())


def test_scan_keeps_rows_beside_copies_of_the_query():
    ids, v = np.array([7] * 20 + [8, 8, 9]), np.ones((23, 2))
    best = vafile.scan(v[:1], ids[:1], ids, v, 3, 2, (np.zeros(0, np.int64),) * 2 + (np.zeros(0),))
    assert best[1].tolist() == [8, 8, 9]


def test_bounds_spare_exact_reads():
    rnd = np.random.default_rng(0)
    v = np.floor(256 * rnd.normal(0, 0.125, (4000, 64)))
    stats: dict = {}
    best = vafile.scan(v[:20], np.arange(20), np.arange(4000), v, 5, 2, (np.zeros(0, np.int64),) * 2 + (np.zeros(0),), stats)
    assert len(best[0]) == 100 and stats["read"] < 0.1 * 20 * 4000
