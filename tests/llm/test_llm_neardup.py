"""Operator 13: near-duplicates against brute force; signatures and posterior bounds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import bayesdedup as bd


def lower_az(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingle_set(t):
    w = lower_az(t).encode().split()
    return frozenset([b" ".join(w)] if 0 < len(w) < 5 else [b" ".join(w[i: i + 5]) for i in range(len(w) - 4)])


def brute(rows, num=85, den=100):
    """Links between texts; a component is named by its least doc_id."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def near_copies(rnd, text, n, most):
    for _ in range(n):
        w = text.split()
        for _ in range(rnd.randint(0, most)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10 ** 6)}"
        yield " ".join(w)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("clash"), "component_id": F.lit(1.5)})
    return sorted((tuple(r) for r in bd.near_duplicates(df.repartition(5)).collect()), key=repr)


def corpus(rnd):
    make = lambda n: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    passage, texts = make(40), []
    for n in (8, 20, 60, 150, 400):
        texts += list(near_copies(rnd, make(n), 25, max(1, n // 30)))
    texts += [f"{make(rnd.randint(5, 60))} {passage}" for _ in range(80)] + [passage] * 5
    texts += ["", "  \n", None, "one two", "One  TWO", "one two three four", "a b c d e", "A B C D E f", "x", "x"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) for _ in range(100)]
    texts += list(near_copies(rnd, passage, 30, 2)) + list(near_copies(rnd, make(30_000), 3, 40))
    rnd.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [1000, 6])
def test_like_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(bd, "BLOCK_SETS", block)
    rows = corpus(random.Random(13))
    assert found(spark, rows) == brute(rows)


def test_rows_without_ids_and_ids_with_two_texts(spark):
    rnd = random.Random(3)
    base = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    rows = []
    for i, b in enumerate(base):
        for t in near_copies(rnd, b, 12, 1):
            rows.append((None if rnd.random() < 0.4 else rnd.randint(0, 30), t))
    rows += [(5, base[0]), (5, base[1]), (5, base[1]), (None, base[2]), (None, base[2]), (None, None), (None, ""), (None, "only this")]
    want = [(d, n, c, (d == c) or (d is None and c is None)) for d, n, c, _ in brute(rows)]
    assert found(spark, rows) == sorted(want, key=repr)


def test_large_group_of_similar_sets_below_the_bound(spark, monkeypatch):
    """Sets that are candidates of each other, most of them not linked."""
    monkeypatch.setattr(bd, "BLOCK_SETS", 9)
    rnd = random.Random(21)
    rows = list(enumerate(near_copies(rnd, " ".join(f"w{i}" for i in range(120)), 70, 5)))
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, [(1, None)]) == [(1, 0, 1, True)]
    assert bd.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_posterior_bound():
    """The bound is the posterior of a uniform prior, by numerical integration."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for n, least in zip(range(bd.BATCH, bd.BANDS * bd.ROWS + 1, bd.BATCH), bd.least_matches(17, 20, 1e-4), strict=True):
        def tail(m):
            d = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid))
            return d[grid >= 0.85].sum() / d.sum()
        assert tail(least) >= 1e-4 > tail(least - 1)


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2 ** 64, 1400, dtype=np.uint64)
    a, b = np.sort(pool[:1200]), np.sort(pool[200:])
    v = bd.minhashes(np.concatenate([a, b]), np.array([0, 1200, 2400]), 0, 192)
    assert abs((v[0] == v[1]).mean() - 1000 / 1400) < 0.1
    many = [bd.minhashes(np.concatenate([x, y]), np.array([0, 90, 180]), 0, 192) for x, y in
            ((p[:90], p[10:100]) for p in (rng.integers(0, 2 ** 64, 100, dtype=np.uint64) for _ in range(200)))]
    assert abs(np.mean([(v[0] == v[1]).mean() for v in many]) - 0.8) < 0.01
