import math

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import similarity as S
from lodestar.operators import textfeatures as TF
from lodestar.sources import readers


def _words(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [r.word for r in TF.all_words(TF.tokenize(df)).collect()]


def test_tokens_letters_only_lowercase(spark):
    assert _words(spark, "Hello, WORLD! it's 42 über-cool") == ["hello", "world", "it", "s", "ber", "cool"]


def test_tokens_no_letters_and_empty(spark):
    assert _words(spark, "1234 !! ") == []
    assert _words(spark, "") == []


def test_tokens_non_ascii_capital_never_becomes_ascii(spark):
    # Dotted capital I and the Kelvin sign lower-case to ASCII in Java; they
    # must be removed before lower-casing.
    assert _words(spark, "İstanbul Kelvin") == ["stanbul", "elvin"]


def test_tagged_parse_and_malformed_lines(spark):
    lines = spark.createDataFrame([
        ('<doc id="AU12" url="http://x" title="t">Some text ">here</doc>',),
        ('<doc id="7" title="no url">text</doc>',),
        ('plain line',),
        ('<doc id="lodestar-docs-grp/5" url="u">Body</doc>',),
    ], "value string")
    got = {r.doc_id: r.text for r in readers.parse_tagged(lines).collect()}
    assert got == {"AU12": 'Some text ">here', "lodestar-docs-grp/5": "Body"}
    grouped = {r.doc_id for r in readers.parse_tagged(lines, skip=14).collect()}
    assert "grp/5" in grouped


def test_prefix_and_group_labels(spark):
    df = spark.createDataFrame([("AU123",), ("XAU",), ("comp.graphics/37261",)], "id string")
    rows = df.select(T.prefix_label("id").alias("l"), T.group_of("id").alias("g")).collect()
    assert [r.l for r in rows] == [1, 0, 0]
    assert rows[2].g == "comp.graphics"


def test_term_frequency_worked_example(spark):
    # positions [3, 4, 1, 1, 2] -> tf over positions 0..4 = [0, 2/5, 1/5, 1/5, 1/5]
    terms = spark.createDataFrame([(1, p) for p in [3, 4, 1, 1, 2]], "doc_id long, pos int")
    tf = {r.pos: r.tf for r in TF.term_counts(TF.doc_positions(terms)).collect()}
    assert tf == {1: 0.4, 2: 0.2, 3: 0.2, 4: 0.2}


def test_vocabulary_ties_and_bound(spark):
    docs = spark.createDataFrame([(1, "b a c"), (2, "a b d")], "doc_id long, text string")
    vocab = {r.word: r.pos for r in TF.vocabulary(TF.tokenize(docs), 3).collect()}
    # a and b tie at 2 -> alphabetical; c beats d alphabetically
    assert vocab == {"a": 0, "b": 1, "c": 2}


def test_idf_counts_all_documents(spark):
    docs = spark.createDataFrame([(1, "x y"), (2, "x"), (3, "123")], "doc_id long, text string")
    f = TF.TextFeatures(docs, 10)
    idf = {r.pos: r.idf for r in f.idf.collect()}
    vocab = {r.word: r.pos for r in f.vocab.collect()}
    assert math.isclose(idf[vocab["x"]], math.log(3 / 2))
    assert math.isclose(idf[vocab["y"]], math.log(3 / 1))


def test_similarity_fills_zero_scores_by_id(spark):
    docs = spark.createDataFrame([(1, "apple banana"), (2, "cherry"), (3, "date"), (4, "apple")],
                                 "doc_id long, text string")
    f = TF.TextFeatures(docs, 10)
    q = spark.createDataFrame([(0, "banana")], "doc_id long, text string")
    top = [(r.doc_id, r.score) for r in S.similarity_topk(f, q, 3).collect()]
    assert top[0][0] == 1 and top[0][1] > 0
    assert top[1:] == [(2, 0.0), (3, 0.0)]


def test_position_lines_repeat_occurrences(spark):
    docs = spark.createDataFrame([(7, [5, 1, 5])], "doc_id long, positions array<int>")
    assert TF.position_lines(docs).collect()[0].line == "7,1,5,5"


def test_stop_words_drop_out(spark):
    docs = spark.createDataFrame([(1, "the cat and the hat")], "doc_id long, text string")
    vocab = {r.word for r in TF.vocabulary(TF.tokenize(docs), 10, T.STOP_WORDS).collect()}
    assert vocab == {"cat", "hat"}


def test_similarity_tokenises_the_corpus_twice(spark):
    """One pass for the dictionary, one for the positions; all branches share them."""
    import os
    import re

    import __spark_entry__ as E
    df = E.queries()["tfidf_similarity_top30"](spark, os.environ.get("SMOKE", "/root/testdata/sf0.001"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "documents.parquet" in line and "text#" in line]
    assert len(scans) <= 2, plan
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin Cross", plan)
