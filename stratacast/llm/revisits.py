"""Web archive records: not-modified revisits resolved to the response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.llm.common import table
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

# Fixed values of HTTP: headers that a not-modified answer never changes in a stored
# response, because they describe a body or one connection.
NOT_MERGED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
# Query parameters that name a visit and not a page.
TRACKING = r"^(?:utm_[^=]*|gclid|fbclid|ref|sessionid|sid)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Host, path and query by which captures of one page are recognised; null of null.

    Drops scheme, user, default port, ``www.``, fragment, trailing slashes and tracking
    parameters; lower-cases the host; sorts the other parameters.
    """
    rest = F.regexp_replace(F.trim(url), r"#[\s\S]*$", "")
    rest = F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(?:80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.rtrim(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), F.lit("/"))
    query = F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1)
    own = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)
    )
    query = F.array_join(F.array_sort(own), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _lower_headers(headers: Column) -> Column:
    """Headers as an array of (key, value), names in lower case, the last of each name."""
    named = F.transform(
        F.map_entries(headers),
        lambda h: F.struct(F.lower(F.trim(h["key"])).alias("key"), h["value"].alias("value")),
    )
    none = F.array().cast("array<struct<key:string,value:string>>")
    named = F.filter(F.coalesce(named, none), lambda h: h["value"].isNotNull())
    return F.filter(
        named,
        lambda h, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda o: o["key"] == h["key"]),
    )


def _header(headers: str, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))["value"]


def _weak(tag: Column) -> Column:
    """Entity tags compare without their weakness mark."""
    return F.regexp_replace(tag, r"^W/", "")


def _last_response(records: DataFrame) -> DataFrame:
    """Adds ``_prior``: the latest full response before each record of the same page.

    Records are dealt out by range of (page, time, id) and written, so a page with any
    share of the captures spreads over tasks. Each task carries its last response forward
    inside itself; what a page's earlier tasks end with comes from a table of one row for
    each task that such a page reaches over.
    """
    order = ["_at", "record_id", "_type"]
    dealt = records.repartitionByRange("_page", *order).sortWithinPartitions("_page", *order)
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "captures")
    full = F.when(
        (F.col("_type") == "response") & (F.col("_status") == 200) & F.col("_page").isNotNull(),
        F.struct("record_id", "_headers", "payload_digest"),
    )
    dealt = dealt.withColumn("_full", full)
    place = F.struct(*order)
    ends = dealt.where("_page IS NOT NULL").groupBy("_page", "_part").agg(
        F.max_by("_full", F.when(F.col("_full").isNotNull(), place)).alias("_end")
    )
    parts = Window.partitionBy("_page")
    ends = ends.withColumn("_n", F.count("*").over(parts)).where("_n > 1").drop("_n")
    earlier = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_page", "_part", F.last("_end", ignorenulls=True).over(earlier).alias("_carried")
    ).where("_carried IS NOT NULL")
    inside = (
        Window.partitionBy("_page", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    own = dealt.withColumn("_own", F.last("_full", ignorenulls=True).over(inside))
    carried = _measured(carried)
    joined = own.join(carried, ["_page", "_part"], "left")
    return joined.withColumn("_prior", F.coalesce("_own", "_carried")).drop(
        "_own", "_carried", "_full", "_part"
    )


def _measured(carried: DataFrame) -> DataFrame:
    written = materialize(carried, "carried")
    width = F.length(F.to_json("_carried")) + F.length("_page") + 16
    return broadcast_if_small(written, written.agg(F.sum(width)).first()[0] or 0)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolves each not-modified revisit to the latest earlier full response of its page.

    ``records``: record_id, url, captured_at, record_type (``response`` or ``revisit``),
    status, headers (map of strings) and payload_digest. Returns one row per input row:
    record_id, canonical_url, resolution, source_id, headers (array of name and value by
    name) and payload_digest. ``resolution`` is

    - ``full``: a response; headers and digest are its own
    - ``resolved``: a 304 revisit whose validators agree with the earlier response's;
      source_id names that response, whose digest (and thus body) it takes. Headers are the
      response's, replaced by the revisit's where HTTP lets a 304 update them
    - ``changed``: a validator (entity tag, Last-Modified or digest) that both have differs
    - ``unverified``: the two have no validator in common
    - ``missing``: no earlier full response of the page, or no URL; an empty one, and one of
      which nothing is left in canonical form, is none
    - ``other``: any other record

    A full response is one of status 200. Captures of the same instant follow their ids.
    Entity tags compare weakly. A null instant or id comes first; header names compare in lower case, of a
    repeated one the last counts; null headers are none. Other columns are ignored.
    """
    rows = records.select(
        F.col("record_id"),
        F.nullif(canonical_url(F.col("url")), F.lit("")).alias("_page"),
        F.col("captured_at").alias("_at"),
        F.lower("record_type").alias("_type"),
        F.col("status").cast("int").alias("_status"),
        _lower_headers(F.col("headers")).alias("_headers"),
        F.col("payload_digest"),
    )
    found = _last_response(rows)
    prior = F.col("_prior._headers")
    checks = [
        (_weak(_header("_headers", "etag")), _weak(_header("_prior._headers", "etag"))),
        (_header("_headers", "last-modified"), _header("_prior._headers", "last-modified")),
        (F.col("payload_digest"), F.col("_prior.payload_digest")),
    ]
    verdicts = F.filter(F.array(*[a == b for a, b in checks]), lambda v: v.isNotNull())
    revisit = (F.col("_type") == "revisit") & (F.coalesce("_status", F.lit(304)) == 304)
    resolution = (
        F.when(F.col("_type") == "response", "full")
        .when(~F.coalesce(revisit, F.lit(False)), "other")
        .when(F.col("_prior").isNull(), "missing")
        .when(F.size(verdicts) == 0, "unverified")
        .when(F.exists(verdicts, lambda v: ~v), "changed")
        .otherwise("resolved")
    )
    # Headers that the revisit names in Connection are its own as well.
    named = F.transform(
        F.split(F.coalesce(_header("_headers", "connection"), F.lit("")), ","),
        lambda n: F.lower(F.trim(n)),
    )
    fixed = F.array(*map(F.lit, NOT_MERGED))
    update = F.filter(
        "_headers",
        lambda h: ~F.array_contains(fixed, h["key"]) & ~F.array_contains(named, h["key"]),
    )
    kept = F.filter(prior, lambda h: ~F.exists(update, lambda u: u["key"] == h["key"]))
    done = F.col("resolution") == "resolved"
    return found.withColumn("resolution", resolution).select(
        "record_id",
        F.col("_page").alias("canonical_url"),
        "resolution",
        F.when(done, F.col("_prior.record_id")).alias("source_id"),
        F.array_sort(F.when(done, F.concat(kept, update)).otherwise(F.col("_headers"))).alias(
            "headers"
        ),
        F.when(done, F.col("_prior.payload_digest")).otherwise(F.col("payload_digest")).alias(
            "payload_digest"
        ),
    )


def with_payloads(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Adds the body of each resolved record from ``payloads`` (record_id, payload)."""
    bodies = payloads.select(F.col("record_id").alias("_body_of"), "payload")
    key = F.coalesce("source_id", "record_id")
    return resolved.withColumn("_body_of", key).join(bodies, "_body_of", "left").drop("_body_of")


def captures(pages: DataFrame) -> DataFrame:
    """Every page as two records: its full response, and a revisit 500 captures later.

    Both carry the entity tag of the page's body. Where another response of the same
    canonical URL lies between, the revisit meets that one, with another tag.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    at = F.col("page_id") * 1000
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        at.alias("captured_at"),
        F.lit("response").alias("record_type"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
            F.lit("Date"), at.cast("string"),
            F.lit("ETag"), tag,
        ).alias("headers"),
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("payload_digest"),
    )
    later = at + 500_500
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        later.alias("captured_at"),
        F.lit("revisit").alias("record_type"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("content-length"), F.lit("0"),
            F.lit("date"), later.cast("string"),
            F.lit("etag"), F.concat(F.lit("W/"), tag),
            F.lit("cache-control"), F.lit("max-age=600"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return full.unionByName(again)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.transform("headers", lambda h: F.concat_ws(": ", h["key"], h["value"]))
    return resolve_revisits(captures(table(spark, sf_dir, "pages"))).select(
        "record_id",
        "canonical_url",
        "resolution",
        F.coalesce("source_id", F.lit(-1).cast("long")).alias("source_id"),
        F.array_join(headers, "\n").alias("headers"),
        "payload_digest",
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u
  FROM pages
), c AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)),
      '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
    || rtrim(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/') AS base,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|gclid|fbclid|ref|sessionid|sid)(=|$)'))), '&') AS q
  FROM p
), k AS (
  SELECT page_id, html, CASE WHEN q = '' THEN base ELSE base || '?' || q END AS page FROM c
), r AS (
  SELECT page_id * 2 AS record_id, page, page_id * 1000 AS t, TRUE AS response, html FROM k
  UNION ALL
  SELECT page_id * 2 + 1, page, page_id * 1000 + 500500, FALSE, html FROM k
), a AS (
  SELECT *, last_value(CASE WHEN response THEN record_id END IGNORE NULLS) OVER w AS prior,
    last_value(CASE WHEN response THEN html END IGNORE NULLS) OVER w AS body,
    last_value(CASE WHEN response THEN t END IGNORE NULLS) OVER w AS prior_t
  FROM r WINDOW w AS (PARTITION BY page ORDER BY t, record_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT record_id, page AS canonical_url,
  CASE WHEN response THEN 'full' WHEN md5(html) = md5(body) THEN 'resolved' ELSE 'changed' END AS resolution,
  CASE WHEN NOT response AND html = body THEN prior ELSE -1 END AS source_id,
  CASE WHEN response THEN 'content-length: ' || octet_length(encode(html)) || chr(10) || 'content-type: text/html'
      || chr(10) || 'date: ' || t || chr(10) || 'etag: "' || md5(html) || '"'
    WHEN html = body THEN 'cache-control: max-age=600' || chr(10) || 'content-length: '
      || octet_length(encode(body)) || chr(10) || 'content-type: text/html' || chr(10)
      || 'date: ' || t || chr(10) || 'etag: W/"' || md5(html) || '"'
    ELSE 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || chr(10)
      || 'date: ' || t || chr(10) || 'etag: W/"' || md5(html) || '"' END AS headers,
  CASE WHEN response THEN sha256(html) WHEN html = body THEN sha256(body) END AS payload_digest
FROM a
"""
