"""Queries of the training-data operators, with SQL where it can express them.

Each query applies its operator with production parameters to the whole table;
digest columns are derived here from the operator's own outputs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


@query("op2_token_bitpack")
def op2_token_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import bitpack
    files = bitpack.write_packed(table(spark, sf_dir, "documents", "doc_id", "text"))
    return bitpack.read_packed(files).withColumnRenamed("key", "doc_id")


@query("op3_prefix_bpe")
def op3_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import prefixbpe
    coded = prefixbpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op5_token_group_join")
def op5_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import tokengroups
    return tokengroups.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query("op4_fm_decontaminate", rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, len(w) AS n, unnest(CASE WHEN len(w) >= 10
    THEN list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS win FROM item),
sized AS (SELECT item_id, win, least(n, 10) AS n FROM iw),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pos AS (
  SELECT doc_id, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, w FROM doc, (SELECT DISTINCT n FROM sized) s WHERE len(w) >= s.n),
occ AS (SELECT p.doc_id, p.i, p.n, s.item_id FROM pos p JOIN sized s ON s.n = p.n AND s.win = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op4_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import fmindex
    found = fmindex.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_two_pass_shuffle")
def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import twopass
    written = twopass.write_shards(table(spark, sf_dir, "documents", "doc_id", "text"), shards=24, seed=8)
    return written.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_vector_approximation", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op9_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import vafile
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vafile.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text modulo 5 is 0 (null ids: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


@query("op6_toxicity_grammar")
def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import toxicity
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("clauses").alias("n_clauses"))


@query("op1_quality_discriminant")
def op1_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import quality
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(documents, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


# Capture records derived from the pages: every page is a full response, and is visited again
# (some before it was stored) by another spelling of its URL with one of five validator states.
_WARC = """
WITH p AS (
  SELECT page_id, url, length(html) AS n, concat('"', substr(md5(html), 1, 16), '"') AS tag FROM {pages})
SELECT concat('r', page_id) AS record_id, 'response' AS record_type, url, page_id * 60 AS ts, tag AS etag,
  concat('day ', page_id % 11) AS last_modified, 'text/html' AS content_type, CAST(n AS {text}) AS content_length,
  CAST(NULL AS {text}) AS cache_control, CAST(NULL AS {text}) AS connection, CAST(page_id * 60 AS {text}) AS date FROM p
UNION ALL
SELECT concat('v', page_id), 'revisit', concat(replace(replace(url, 'https://', 'HTTP://'), '#top', ''), '#again'),
  CASE WHEN page_id % 9 = 0 THEN page_id * 60 - 30 ELSE page_id * 60 + 5850 END,
  CASE page_id % 5 WHEN 0 THEN '"changed"' WHEN 1 THEN concat('W/', tag) WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE tag END,
  CASE page_id % 5 WHEN 2 THEN concat('day ', page_id % 11) END,
  NULL, '0', 'max-age=60', 'close', CAST(page_id * 60 + 5850 AS {text}) FROM p
"""
_FIELDS = ("etag", "last_modified", "content_type", "content_length", "cache_control", "connection", "date")


def _sql_canonical(u: str) -> str:
    u = f"regexp_replace(regexp_replace(trim({u}), '#.*$', ''), '^[A-Za-z]+://', '')"
    host = rf"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract({u}, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')"
    rest = rf"regexp_replace(regexp_replace({u}, '^[^/?]*', ''), '([?&])utm_[^&]*', '\1', 'g')"
    rest = rf"regexp_replace(regexp_replace({rest}, '&&+', '&', 'g'), '\?&+', '?', 'g')"
    return rf"concat({host}, regexp_replace(regexp_replace({rest}, '[?&]+$', ''), '/+$', ''))"


def _sql_lines(pairs: list[tuple[str, str]]) -> str:
    items = ", ".join(f"CASE WHEN {v} IS NOT NULL THEN concat('{k.replace('_', '-')}: ', {v}) END" for k, v in pairs)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), chr(10))"


_BODY = ("content_type", "content_length", "connection")


@query("op7_warc_revisits", f"""
WITH rec AS ({_WARC.format(pages="pages", text="VARCHAR")}),
c AS (SELECT *, {_sql_canonical("url")} AS canonical FROM rec),
j AS (
  SELECT v.*, r.record_id AS base, {", ".join(f"r.{f} AS b_{f}" for f in _FIELDS)},
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC, r.record_id DESC) AS k
  FROM c v LEFT JOIN c r ON r.record_type = 'response' AND r.canonical = v.canonical
    AND (r.ts < v.ts OR r.ts = v.ts AND r.record_id < v.record_id)
  WHERE v.record_type = 'revisit'),
o AS (
  SELECT *, CASE WHEN base IS NULL THEN 'no earlier response'
    WHEN etag IS NOT NULL AND b_etag IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(b_etag, '^W/', '') THEN 'resolved' ELSE 'changed' END
    WHEN last_modified IS NOT NULL AND b_last_modified IS NOT NULL THEN
      CASE WHEN last_modified = b_last_modified THEN 'resolved' ELSE 'changed' END
    ELSE 'no validator' END AS outcome FROM j WHERE k = 1)
SELECT record_id, canonical, outcome, CASE WHEN outcome = 'resolved' THEN base END AS refers_to,
  CASE WHEN outcome = 'resolved'
    THEN {_sql_lines([(f, f"b_{f}" if f in _BODY else f"coalesce({f}, b_{f})") for f in _FIELDS])}
    ELSE {_sql_lines([(f, f) for f in _FIELDS])} END AS header_lines
FROM o
""")
def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import revisits
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    records = spark.sql(_WARC.format(pages="{pages}", text="STRING"), pages=pages)
    fields = F.create_map(*[x for f in _FIELDS for x in (F.lit(f.replace("_", "-")), F.col(f))])
    records = records.withColumn("headers", F.map_filter(fields, lambda _, v: v.isNotNull()))
    found = revisits.resolve(records.select("record_id", "record_type", "url", "ts", "headers"))
    return found.withColumn("header_lines", revisits.header_lines(F.col("headers"))).drop("headers")


@query("op10_perspective_rotation", """
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS said, CAST(floor(coalesce(turn, 0) / 256) AS INTEGER) AS part
  FROM conversations),
people AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
s AS (
  SELECT t.*, participant, coalesce(role = participant, false) AS own,
    CASE WHEN role = 'system' THEN '<|system|>' WHEN role = participant THEN '<|assistant|>'
      ELSE concat('<|user name=', coalesce(role, 'unknown'), '|>') END || chr(10) AS head
  FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
l AS (
  SELECT *, length(head) + length(said) + 8 AS n,
    sum(length(head) + length(said) + 8) OVER w - (length(head) + length(said) + 8) AS pos,
    sum(length(head) + length(said) + 8) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, role NULLS FIRST, said
      ROWS UNBOUNDED PRECEDING) - (length(head) + length(said) + 8) AS whole
  FROM s WINDOW w AS (PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, role NULLS FIRST, said ROWS UNBOUNDED PRECEDING))
SELECT conv_id, participant, part, CAST(count(*) AS INTEGER) AS n_turns, CAST(min(whole) AS BIGINT) AS char_start,
  sha256(string_agg(head || said || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, said)) AS text_sha256,
  coalesce(string_agg(CAST(CAST(pos + length(head) AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(pos + n - 1 AS INTEGER) AS VARCHAR), ','
    ORDER BY turn NULLS FIRST, role NULLS FIRST, said) FILTER (WHERE own), '') AS masks
FROM l GROUP BY conv_id, participant, part
""")
def op10_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import perspectives
    seen = perspectives.rotate(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    masks = F.transform("masks", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return seen.select("conv_id", "participant", "part", "n_turns", "char_start", F.sha2("text", 256).alias("text_sha256"),
                       F.array_join(masks, ",").alias("masks"))


@query("op11_piece_table_fim", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256(concat('42:', doc_id)) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
u AS (
  SELECT doc_id, t, w, len(w) AS n, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) % (len(w) + 1) AS a,
    CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR CAST(concat('0x', substr(h, 17, 8)) AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST(concat('0x', substr(h, 25, 8)) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (
  SELECT *, array_to_string(w[1:least(a, b)], '') AS pre, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS mid,
    array_to_string(w[greatest(a, b) + 1:], '') AS suf FROM u),
o AS (
  SELECT *, CASE form WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
    WHEN 'spm' THEN concat('<S>', suf, '<P>', pre, '<M>', mid) ELSE t END AS output FROM s),
b AS (
  SELECT *, CASE form
    WHEN 'psm' THEN concat(substr(split_part(output, '<S>', 1), 4), split_part(output, '<M>', 2), split_part(split_part(output, '<M>', 1), '<S>', 2))
    WHEN 'spm' THEN concat(split_part(split_part(output, '<M>', 1), '<P>', 2), split_part(output, '<M>', 2), substr(split_part(output, '<P>', 1), 4))
    ELSE output END AS restored FROM o)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM b
""")
def op11_piece_table_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import piecetable
    made = piecetable.restore(piecetable.fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                       F.sha2("restored", 256).alias("restored_sha256"))


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op12_k2_treap_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
g AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT i, term, count(*) AS c FROM (SELECT i, unnest(w) AS term FROM i) GROUP BY i, term),
s AS (
  SELECT q.i, t.r, CAST(sum(q.c * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(d.w) * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN f USING (term) JOIN d ON d.r = t.r, g GROUP BY q.i, t.r),
k AS (
  SELECT i, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k JOIN i USING (i) WHERE rank <= 20
""")
def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import k2treap
    index = k2treap.build_index(table(spark, sf_dir, "documents", "doc_id", "text"))
    return k2treap.rank(index, table(spark, sf_dir, "benchmark", "item_id", "text"), k=20)


@query("op13_bayes_near_dedup")
def op13_bayes_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestar.llm import bayesdedup
    return bayesdedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
