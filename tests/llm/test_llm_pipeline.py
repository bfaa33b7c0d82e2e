"""Registered queries and the pipeline on the given tables, stage by stage against plain versions."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_search import brute_components, brute_hits

import __spark_entry__ as E
import corpus_pipeline
from lodestar.llm import plans
from lodestar.session import BATCH_BYTES, bound_batches

TINY = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11))
    assert set(plans.ORACLE) <= names


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TINY}/{t}.parquet')")
    res = con.execute(plans.ORACLE[name])
    columns = sorted(d[0] for d in res.description)
    want = [tuple(r) for r in res.df()[columns].astype(object).where(lambda x: x.notna(), None).itertuples(index=False)]
    got = plans.QUERIES[name](spark, TINY)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, ([*r] for r in want))) == sorted(map(repr, ([*r] for r in got.select(columns).collect())))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "s", None), (9002, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", F.lit("clash"))
    stages = [f for _, f in corpus_pipeline.STAGES]
    a = stages[0](spark, docs, TINY).cache()
    assert a.columns == list(corpus_pipeline.COLUMNS) and a.count() <= docs.count()
    b = stages[1](spark, a, TINY).cache()
    assert {9001, 9002} <= {r.doc_id for r in b.select("doc_id").collect()}
    c = stages[2](spark, b, TINY).cache()
    rows = [(r.doc_id, r.text) for r in b.collect()]
    assert sorted(r.doc_id for r in c.collect()) == sorted(d for d, _, k in brute_components(rows) if d == k)
    d = stages[3](spark, c, TINY).cache()
    assert d.count() == c.count()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    after = d.collect()
    assert all(h == 0 for _, h, _ in brute_hits([r.text for r in after], items, 10))
    untouched = {i: t for (i, t), (_, h, _) in zip(((r.doc_id, r.text) for r in c.collect()), brute_hits([r.text for r in c.collect()], items, 10),
                                                   strict=True) if h == 0}
    assert all(r.text == untouched[r.doc_id] for r in after if r.doc_id in untouched)
    assert all(r.text is None or len(r.text) == r.n_chars for r in after if r.doc_id not in untouched)
    e = stages[4](spark, d, TINY)
    assert e.count() == d.count() and min(r.n_tokens for r in e.collect()) == 0


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TINY)
    assert docs.count() == 0


def test_pipeline_bounds_the_bytes_of_a_batch(spark):
    session = spark.newSession()
    docs = session.range(4000).selectExpr("id AS doc_id", "repeat('many words ', 400) AS text", "'en' AS lang", "'s' AS source", "4400L AS n_chars").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "z"])

    corpus_pipeline.encode(session, docs, TINY)
    got = docs.mapInArrow(sizes, "n long, z long").collect()
    assert sum(r.n for r in got) == 4000 and max(r.z for r in got) < 2 * BATCH_BYTES
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    bound_batches(own)
    assert own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
