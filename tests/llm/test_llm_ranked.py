"""Operator 12: K2-treaps and ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import k2treap as kt

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [c for c in counted if c[2]]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in set(items):
        asked, scored = Counter(terms(text)), []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
                    for w, q in asked.items() if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        scored.sort()
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(scored[:k])]
    return sorted(out, key=repr)


def some_docs(rnd, n, words):
    return [(rnd.choice([None, *range(n)]) if rnd.random() < 0.1 else i,
             rnd.choice([None, "", " .", "A-b c", "é É 9z"]) if rnd.random() < 0.1 else
             " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 20, 200])))) for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_like_brute_force(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    words = [f"W{int(rnd.paretovariate(0.6)) % 900}" for _ in range(rnd.choice([5, 300]))]
    docs = some_docs(rnd, rnd.choice([1, 60, 500]), words)
    docs += docs[:3] + [(7, "common text under one id")] * 40 + [(900 + i, "common text under one id") for i in range(40)]
    items = [(i % 9 or None, " ".join(rnd.choice([*words, "unknown", "common", "text"]) for _ in range(rnd.randint(0, 30))))
             for i in range(14)] + [(3, None), (4, ""), (5, "common text"), (5, "common text")]
    monkeypatch.setattr(kt, "SHARD_BYTES", rnd.choice([200, 5000, 1 << 20]))
    monkeypatch.setattr(kt, "BLOCK_BYTES", rnd.choice([300, 1 << 20]))
    monkeypatch.setattr(kt, "STEP", rnd.choice([1, 2, 3]))
    monkeypatch.setattr(kt, "FIRST_SPANS", rnd.choice([1, 4, 16]))
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"i": F.lit(1), "score": F.lit("x")}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit(1), "doc_id": F.lit(2)})
    got = kt.rank(kt.build_index(table), asked, k=rnd.choice([1, 5, 20]) if seed else 20)
    k = max((r.rank for r in got.collect()), default=20)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert kt.rank(kt.build_index(docs), items).collect() == []
    assert kt.rank(kt.build_index(spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")), items).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert kt.rank(kt.build_index(some), items.where("false")).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_tree_holds_every_posting(seed, monkeypatch):
    monkeypatch.setattr(kt, "STEP", seed % 3 + 1)
    monkeypatch.setattr(kt, "FIRST_SPANS", seed % 5 + 1)
    rng = np.random.default_rng(seed)
    rows, cols = rng.integers(1, 70), rng.integers(1, 300)
    there = rng.random((rows, cols)) < rng.choice([0.01, 0.3, 1.0])
    there[rng.integers(rows), rng.integers(cols)] = True
    r, c = np.nonzero(there)
    impact = rng.integers(1, 1000, len(r))
    t = kt.Treap.load(kt.build(r, c, impact).dump())
    dense = np.zeros((rows, cols), np.int64)
    dense[r, c] = impact
    ids = np.sort(rng.integers(0, 50, cols))
    chosen = rng.choice(rows, rng.integers(1, rows + 1), replace=False)
    weight = rng.integers(1, 9, len(chosen))
    total = (weight[:, None] * dense[chosen]).sum(axis=0)
    want = sorted((-int(s), int(i)) for s, i in zip(total, ids, strict=True) if s > 0)[:10]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    item = kt._Item(np.arange(len(chosen)), weight, 10, none)
    other = kt._Item(np.arange(1), weight[:1], 3, none)
    kt.search(t, ids, chosen, [other, item])
    score, doc = item.best
    assert [(-int(s), int(d)) for s, d in zip(score, doc, strict=True)] == want


def test_search_opens_few_documents(monkeypatch):
    """A rare term bounds the search: most ranges of documents are never opened."""
    rng = np.random.default_rng(5)
    there = rng.random((64, 4096)) < 0.2
    there[63] = False
    there[63, [5, 900, 4000]] = True
    r, c = np.nonzero(there)
    t = kt.build(r, c, rng.integers(1, 100, len(r)))
    opened = []
    plain = kt._open
    monkeypatch.setattr(kt, "_open", lambda t, p, rows, wanted: opened.append((p.level, int(wanted.sum()))) or plain(t, p, rows, wanted))
    monkeypatch.setattr(kt, "STEP", 1)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    item = kt._Item(np.arange(2), np.array([1000, 1]), 3, none)
    kt.search(t, np.arange(4096), np.array([63, 1]), [item])
    assert sorted(item.best[1].tolist()) == [5, 900, 4000]
    assert sum(n for level, n in opened if level == 1) < 2048 / 4       # ranges of two documents
