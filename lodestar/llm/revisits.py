"""Not-modified revisit records resolved to full responses (operator 7).

A revisit (a 304 answer) refers to the latest earlier full response of its canonical
URL.  The as-of join is a window per URL and time bucket plus a window over the
bucket ends per URL, so a URL with a third of all records is spread over its buckets;
only identifiers, times and headers move, no payloads.  Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 6 * 3600

# Fields of a 304 answer that never replace those of the stored response (fixed values):
# hop-by-hop fields and fields that describe the answer's own (empty) body.
NOT_MERGED = ("connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
              "transfer-encoding", "upgrade", "content-length", "content-encoding", "content-type", "content-range")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case; no scheme difference between http and https, no user,
    leading www., default port, fragment, utm_ parameters or final slash."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z]+://", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(u, r"^[^/?]*", "")
    rest = F.regexp_replace(rest, r"([?&])utm_[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"&&+", "&"), r"\?&+", "?")
    rest = F.regexp_replace(rest, r"[?&]+$", "")
    return F.concat(host, F.regexp_replace(rest, r"/+$", ""))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit of ``records(record_id string, record_type string, url string, ts long
    seconds, headers map<string,string>)``, keyed by lower-case field names:

    ``record_id, canonical, outcome, refers_to, headers``.  The outcome is ``resolved`` (entity tags
    agree in weak comparison or, when one has none, the Last-Modified dates agree),
    ``changed`` (they don't), ``no validator`` or ``no earlier response``.  Resolved rows have the
    stored fields overwritten by the revisit's permitted ones; others keep the revisit's.

    Earlier means a smaller (ts, record_id).  Records without URL or time resolve to
    nothing and are no candidates; null headers count as empty; repeated records
    give repeated rows.  Records of other types and extra columns are ignored.
    """
    no_fields = F.create_map().cast("map<string,string>")
    slim = (records.where(F.col("record_type").isin("response", "revisit"))
            .select("record_id", (F.col("record_type") == "response").alias("full"), canonical_url(F.col("url")).alias("canonical"),
                    "ts", F.coalesce("headers", no_fields).alias("headers"))
            .withColumn("bucket", F.floor(F.col("ts") / bucket_seconds)))
    usable = F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    known, odd = slim.where(usable), slim.where(~usable & ~F.col("full"))
    stored = F.struct("record_id", "headers")
    place = F.struct("ts", "record_id")
    before = Window.partitionBy("canonical", "bucket").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = known.withColumn("near", F.last(F.when(F.col("full"), stored), ignorenulls=True).over(before))
    ends = known.groupBy("canonical", "bucket").agg(F.max_by(stored, F.when(F.col("full"), place)).alias("end"))
    earlier = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("canonical", "bucket", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    found = (near.where("not full").join(carried, ["canonical", "bucket"])
             .select("record_id", "canonical", "headers", F.coalesce("near", "carried").alias("base")))
    found = found.unionByName(odd.select("record_id", "canonical", "headers", F.lit(None).cast(found.schema["base"].dataType).alias("base")))

    mine, theirs = F.col("headers"), F.col("base.headers")
    tags = mine["etag"].isNotNull() & theirs["etag"].isNotNull()
    dates = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    agree = F.when(tags, _strong(mine["etag"]) == _strong(theirs["etag"])).when(dates, mine["last-modified"] == theirs["last-modified"])
    outcome = (F.when(F.col("base").isNull(), "no earlier response").when(agree.isNull(), "no validator")
               .when(agree, "resolved").otherwise("changed"))
    permitted = F.map_filter(mine, lambda k, _: ~k.isin(*NOT_MERGED))
    kept = F.map_filter(theirs, lambda k, _: ~F.map_contains_key(permitted, k))
    return found.withColumn("outcome", outcome).select(
        "record_id", "canonical", "outcome", F.when(F.col("outcome") == "resolved", F.col("base.record_id")).alias("refers_to"),
        F.when(F.col("outcome") == "resolved", F.map_concat(kept, permitted)).otherwise(mine).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Fields as sorted ``name: value`` lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
