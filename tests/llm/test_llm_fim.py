"""Operator 11: piece tables against plain string work, and round trips."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lodestar.llm import piecetable as pt

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def brute(key, text, rate=50, spm=80):
    t = text or ""
    w = TOKEN.findall(t)
    h = SHA(f"42:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(w) + 1), h2 % (len(w) + 1)))
    pre, mid, suf = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(w), "plain", None, None, t
    if h4 % 100 < spm:
        return len(w), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(w), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rnd = random.Random(11)
    bits = ["a", "bc", "é", "日本", "🙂", " ", "  ", "\n", "\t\x0b", "\x1f", " ", "\0", "<P", ">", "<S"]
    made = ["", None, " ", "\n\n", "x", " x", "x ", "<M> in it", "é" * 300_000, "w " * 200_000, "\x0c"]
    return made + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(400)]


@pytest.mark.parametrize("rate,spm", [(50, 80), (100, 50), (0, 0)])
def test_like_plain_strings(spark, rate, spm):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (3, "x"), (3, "x"), (3, "other text of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({"n": F.lit("clash"), "form": F.lit(1), "restored": F.lit(0.5), "more": F.lit("kept")})
    made = pt.restore(pt.fill_in_middle(docs, rate=rate, spm=spm))
    got = sorted(made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256",
                             "restored", "more").collect(), key=repr)
    want = []
    for k, t in rows:
        n, form, p, m, out = brute(k, t, rate, spm)
        want.append((k, t, n, form, p, m, out, SHA(out), t or "", "kept"))
    assert [tuple(r) for r in got] == sorted(want, key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pt.restore(pt.fill_in_middle(docs)).collect() == []


def test_cutting_splits_descriptors_and_shares_buffers():
    data = memoryview(b"one two three")
    whole = pt.Pieces.whole(data)
    parts = whole.cut(3, 3, 7)
    assert [p.bytes() for p in parts] == [b"one", b"", b" two", b" three"]
    assert all(p.buffers is whole.buffers for p in parts)
    again = pt.Pieces(whole.buffers, parts[3].items + parts[0].items).cut(0, 4, 9)
    assert [p.bytes() for p in again] == [b"", b" thr", b"eeone", b""]
    for form in pt.FORMS:
        out = pt.arrange(whole.cut(3, 7), form)
        assert pt.restore_pieces(pt.Pieces.whole(memoryview(out.bytes())), form).bytes() == bytes(data)


def test_damaged_output_fails(spark):
    bad = spark.createDataFrame([("<P>a<S>b", "psm")], "output string, form string")
    with pytest.raises(Exception, match="subsection not found"):
        pt.restore(bad).collect()
