"""Not-modified revisits of web archives, resolved by an as-of join.

A revisit record takes the payload of the latest full response with the same canonical URL and an earlier time, if
its validators agree, and that response's headers with those that a 304 answer may carry replaced by its own.

One URL may hold much of an archive, so no task gets all records of a URL: time is cut into ranges of about
RANGE_ROWS records each, whatever outliers there are, so that their number grows with the archive (records of one time stay together). Within a (URL, range) a window
finds the latest earlier response; the last response of each (URL, range), aggregated before it is shuffled, is
carried to later ranges by a window of one row a range. Only identifiers and times go through both; payloads, of
those responses only that some revisit refers to, are joined by record id afterwards, in a join that Spark can split
where one response has many revisits; revisits without a source take no part in it.

Defined results, as column status: resolved; mismatch (a validator differs); unvalidated (no common validator); orphan
(no earlier response, or no URL or time). Only resolved revisits get a payload and merged headers. Equal times are
not earlier; among responses of one time the greatest record_id counts; of responses that share a record_id the one
with the greatest payload. Repeated revisits stay. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.digests import grown_edges, ranges
from .common import stored

#: Records in a range of time.
RANGE_ROWS = 1 << 18
#: Headers that a not-modified answer may replace (RFC 9110, 15.4.5; fixed values).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
_URL = r"^(?i:https?)://(?i:www\.|m\.)?([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. or m., path without closing slashes, query without ref and utm fields; no scheme or fragment."""
    query = F.regexp_replace(F.regexp_extract(url, _URL, 3), r"([?&])(?:ref|utm_[a-z]+)=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, "[?&]+$", ""), "([?&])&+", "$1")
    path = F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", "")
    return F.when(url.rlike(_URL), F.concat(F.lower(F.regexp_extract(url, _URL, 1)), path, query)).otherwise(url)


def resolve_revisits(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """records: record_id, kind (response or revisit), url, time, headers (map), payload; others are not looked at. One
    row per revisit: record_id, url, time, status, source_id, payload, headers."""
    records = records.select("record_id", "kind", "url", "time", "headers", "payload", canonical_url(F.col("url")).alias("key"))
    full = (F.col("kind") == "response") & F.col("payload").isNotNull()
    timed = records.filter(F.col("key").isNotNull() & F.col("time").isNotNull() & (full | (F.col("kind") == "revisit")))
    edges = grown_edges(timed, F.col("time"), range_rows)
    line = timed.select("key", "time", "record_id", "kind", ranges(F.col("time"), edges).alias("bucket"))
    source = F.when(F.col("kind") == "response", F.struct("time", "record_id"))
    within = Window.partitionBy("key", "bucket").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    near = line.withColumn("near", F.max(source).over(within)).filter("kind = 'revisit'")
    last = line.groupBy("key", "bucket").agg(F.max(source).alias("last"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("key", "bucket", F.last("last", ignorenulls=True).over(before).alias("far")).filter("far is not null")
    found = near.join(carried, ["key", "bucket"], "left").select("record_id", "key", "time", F.coalesce("near.record_id", "far.record_id").alias("source_id"))
    found = stored(found.filter("source_id is not null").distinct(), "sources")

    held = records.filter(full).join(found.select(F.col("source_id").alias("record_id")).distinct(), "record_id", "left_semi")
    held = stored(held.groupBy(F.col("record_id").alias("source_id")).agg(F.max_by(F.struct("headers", "payload"), "payload").alias("source")), "responses")
    revisits = records.filter("kind = 'revisit'").select("record_id", "url", "key", "time", F.col("headers").alias("own"))
    same = revisits["record_id"].eqNullSafe(found["record_id"]) & (revisits["key"] == found["key"]) & (revisits["time"] == found["time"])
    referring = stored(revisits.join(found, same, "left").select(revisits["*"], "source_id"), "revisits")
    matched = referring.filter("source_id is not null").join(held, "source_id", "left")
    nothing = referring.filter("source_id is null").withColumn("source", F.lit(None).cast(held.schema["source"].dataType))
    matched = matched.unionByName(nothing)
    old = F.col("source.headers")
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    tag = weak(F.col("own")["etag"]) == weak(old["etag"])
    date = F.col("own")["last-modified"] == old["last-modified"]
    agrees = F.coalesce(tag, date)
    status = F.when(F.col("source").isNull(), "orphan").when(agrees, "resolved").when(agrees.isNull(), "unvalidated").otherwise("mismatch")
    allowed = F.map_filter("own", lambda k, v: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False))), F.coalesce(allowed, F.create_map().cast("map<string,string>")))
    resolved = status == "resolved"
    return matched.select("record_id", F.col("key").alias("url"), "time", status.alias("status"), "source_id", F.when(resolved, F.col("source.payload")).alias("payload"), F.when(resolved, merged).alias("headers"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of pages (page_id, url, html): a full response each, and a later revisit by the page's id.

    Responses come at 10 * page_id. The revisit comes 5 to 495 later, with the page's digest as its etag, but that
    every fifth has another etag and every seventh no etag and the last-modified date of its page instead."""
    i = F.col("page_id")
    response = pages.select((2 * i).alias("record_id"), F.lit("response").alias("kind"), "url", (10 * i).alias("time"), F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), (10 * i).cast("string"), F.lit("etag"), F.md5("html"), F.lit("last-modified"), (i % 100).cast("string"), F.lit("server"), F.concat(F.lit("s"), i % 3)).alias("headers"), F.col("html").alias("payload"))
    time = 10 * i + 5 + 10 * (i % 50)
    base = F.create_map(F.lit("date"), time.cast("string"), F.lit("set-cookie"), i.cast("string"))
    mark = F.when(i % 7 == 0, F.create_map(F.lit("last-modified"), (i % 100).cast("string"))).otherwise(F.create_map(F.lit("etag"), F.when(i % 5 == 0, F.lit("changed")).otherwise(F.concat(F.lit("W/"), F.md5("html")))))
    revisit = pages.select((2 * i + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", time.alias("time"), F.map_concat(base, mark).alias("headers"), F.lit(None).cast("string").alias("payload"))
    return response.unionByName(revisit)


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page's revisit; -1 where there is no source page or payload."""
    found = resolve_revisits(records_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select(F.expr("record_id div 2").alias("page_id"), "url", "status", F.expr("coalesce(source_id div 2, -1)").alias("source_page_id"), F.coalesce(F.octet_length("payload").cast("long"), F.lit(-1)).alias("payload_bytes"), F.md5("payload").alias("payload_md5"), headers.alias("headers"))


OP7_SQL = r"""
WITH p AS (
  SELECT page_id AS i, url, html,
    CASE WHEN regexp_matches(url, '^(?i:https?)://') THEN
      lower(regexp_extract(url, '^(?i:https?)://(?i:www\.|m\.)?([^/?#]*)([^?#]*)(\?[^#]*)?', 1))
      || regexp_replace(regexp_extract(url, '^(?i:https?)://(?i:www\.|m\.)?([^/?#]*)([^?#]*)(\?[^#]*)?', 2), '/+$', '')
      || regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^(?i:https?)://(?i:www\.|m\.)?([^/?#]*)([^?#]*)(\?[^#]*)?', 3), '([?&])(?:ref|utm_[a-z]+)=[^&]*', '\1', 'g'), '[?&]+$', ''), '([?&])&+', '\1', 'g')
    ELSE url END AS key
  FROM pages),
r AS (SELECT i, key, html, 10 * i AS t FROM p WHERE html IS NOT NULL),
v AS (SELECT i, key, 10 * i + 5 + 10 * (i % 50) AS t,
  CASE WHEN i % 7 = 0 THEN NULL WHEN i % 5 = 0 THEN 'changed' ELSE md5(html) END AS tag,
  CASE WHEN i % 7 = 0 THEN i % 100 END AS modified, md5(html) AS own FROM p),
j AS (SELECT v.i, v.key, v.t, v.tag, v.modified, r.i AS s, r.html, md5(r.html) AS old_tag, r.i % 100 AS old_modified
  FROM v ASOF LEFT JOIN r ON v.key = r.key AND v.t > r.t),
k AS (SELECT *, CASE WHEN s IS NULL THEN 'orphan' WHEN coalesce(tag = old_tag, modified = old_modified) THEN 'resolved' ELSE 'mismatch' END AS status FROM j)
SELECT i AS page_id, key AS url, status, coalesce(s, -1) AS source_page_id,
  CASE WHEN status = 'resolved' THEN CAST(strlen(html) AS BIGINT) ELSE -1 END AS payload_bytes,
  CASE WHEN status = 'resolved' THEN md5(html) END AS payload_md5,
  CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=' || t || ';etag=' || CASE WHEN tag IS NULL THEN old_tag ELSE 'W/' || tag END
    || ';last-modified=' || old_modified || ';server=s' || (s % 3) END AS headers
FROM k
"""
