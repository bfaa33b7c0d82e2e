"""Operators 1 and 6: parts against plain computations, held-out accuracy on the given tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import plans, quality, toxicity

SMALL = "/root/testdata/sf0.01"


def patterns(text, families=("idiot", "scum")):
    g = toxicity.grammar(dict.fromkeys(families, 3.0))
    return [toxicity.PATTERNS[p] for p, *_ in toxicity.clauses(bw.strings(pa.array([text])), g)[0]]


@pytest.mark.parametrize("text, want", [
    ("what an idiot", ["insult"]), ("you are an Idiots club", ["insult at a target"]), ("he is not an idiot", ["negated insult"]),
    ("she said he is an idiot", ["reported insult"]), ('the word "idiot" was used', ["reported insult"]),
    ("I will kill you", ["threat at a target"]), ("I will hurt dogs", ["threat"]), ("I will not hurt you", ["negated threat"]),
    ("he said I will kill you", ["reported threat"]), ("kill the process", []), ("they will come", []), ("", []),
    ("not now. idiot! fine; scum", ["insult", "insult"]), ("not that there is any real idiot", ["insult"])])
def test_clause_patterns(text, want):
    assert patterns(text) == want


def test_machine_is_the_product_of_its_parts():
    rnd = random.Random(0)
    for _ in range(500):
        i = t = g = n = r = state = 0
        for s in (rnd.randrange(8) for _ in range(rnd.randint(0, 12))):
            i, t, g, n, r = (toxicity._insult(i, s, n > 0, r > 0), toxicity._threat(t, s, n > 0, r > 0), toxicity._target(g, s),
                             toxicity._negation(n, s), toxicity._reported(r, s))
            state = toxicity.NEXT[state, s]
        assert toxicity.FINAL[state] == toxicity._pattern(i, t, g)


def test_clause_spans_are_bytes():
    g = toxicity.grammar({"idiot": 3.0})
    text = "Éh bien. tu es idiot là. fin"
    (p, a, b, w), = toxicity.clauses(bw.strings(pa.array([text])), g)[0]
    assert text.encode()[a:b].decode() == "tu es idiot là" and w == 3.0


def test_covering_prefers_the_common_beginning():
    docs = [["lowe", "lowei", "loweiä"], ["lowe", "lowei", "loweich"], ["lowe", "lowei", "lowein"], ["rare"]]
    counts = {"lowe": (3, 0), "lowei": (3, 0), "loweiä": (1, 0), "loweich": (1, 0), "lowein": (1, 0), "rare": (1, 0)}
    assert list(toxic_cover(docs, counts)) == ["lowei"]


def test_covering_adds_pure_words_of_many_contexts():
    docs = [["idiot", "stupid", "copied"] if i % 2 else ["idiot"] for i in range(40)]
    counts = {"idiot": (40, 0), "stupid": (20, 0), "copied": (20, 0)}
    assert set(toxic_cover(docs, counts, {"copied"})) == {"idiot", "stupid"}


def toxic_cover(docs, counts, one_context=frozenset()):
    return toxicity.cover([[(k, 0 if k in one_context else i) for k in keys] for i, keys in enumerate(docs)], counts, len(docs), 100)


def test_discriminant_equals_plain_densities():
    rnd = np.random.default_rng(0)
    x = np.concatenate([rnd.normal(0, 1, (200, 3)), rnd.normal([2, 0, 1], [2, 1, 0.5], (100, 3))])
    y = np.repeat([1, 0], [200, 100])
    m = quality.discriminant(x, y)
    own = [np.cov(x[y == c].T, bias=True) + 1e-9 * np.eye(3) for c in (0, 1)]
    pooled = own[0] / 3 + own[1] * 2 / 3
    want = []
    for c, share in ((0, 1 / 3), (1, 2 / 3)):
        s = (1 - quality.POOLED) * own[c] + quality.POOLED * pooled
        s = (1 - quality.ROUND) * s + quality.ROUND * np.trace(s) / 3 * np.eye(3)
        d = x - x[y == c].mean(axis=0)
        want.append(np.log(share) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert np.allclose(m.difference(x), want[1] - want[0])
    assert quality.discriminant(x[:200], y[:200]).score(x).tolist() == [1.0] * 300


def test_statistics_of_odd_texts():
    x = quality.statistics(bw.strings(pa.array([None, "", " \n", "plain words here", "A!! B!! CC!!", "to to to to", "a | b | c"])))
    assert (x[:3] == 0).all() and x.shape == (7, len(quality.STATISTICS))
    assert x[4, 0] > 0.5 and x[5, 5] > 0.5 and x[6, 3] > 0.4 and (x[3] == 0).all()


@pytest.mark.parametrize("name, column, auc_least", [("op1_quality_discriminant", "quality", 0.95), ("op6_toxicity_grammar", "toxic", 0.6)])
def test_held_out_accuracy(spark, name, column, auc_least):
    got = plans.QUERIES[name](spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    rows = got.where("held_out").join(labels, "doc_id").select("score", column, "predicted").collect()
    good, bad = ([r.score for r in rows if r[1] == c] for c in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc >= auc_least
    if column == "quality":
        assert all(r.predicted == 1 for r in rows if r[1] == 1)
    else:
        assert not any(r.predicted for r in rows if r[1] == 0)


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_models_on_odd_tables(spark, module, column):
    docs = [(i, f"you idiot number {i}" if i % 2 else f"nice day number {i}") for i in range(60)] + [(100, None), (101, ""), (None, "x"), (3, "again"),
                                                                                                    (102, "idiot " * 30_000)]
    labels = [(i, i % 2) for i in range(60)] + [(None, 1), (100, 1), (101, None), (2, 0), (2, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("y", F.lit("clash"))
    lab = spark.createDataFrame(labels, f"doc_id long, {column} int")
    model = module.fit(d, lab, column)
    got = module.score(d, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.y == "clash" for r in got)
    if module is toxicity:
        assert all((r.score >= 0.5) == bool(r.text and "idiot" in r.text) for r in got)
    nothing = module.fit(d, lab.limit(0), column)
    assert module.score(d, nothing).count() == len(docs)
    assert module.score(d.limit(0), module.fit(d.limit(0), lab, column)).count() == 0
