"""Revisit records of a web archive ("not modified") resolved to the full response they repeat.

An as-of join: a revisit belongs to the latest earlier full response of its canonical URL. The
revisit's validators must agree with that response (entity tags compared weakly, else the date of the
last change); headers that a 304 answer may update replace those of the stored response.

A URL may hold any share of the records. Records are therefore laid out by range on (URL, time), and
each range looks back only within itself; what earlier ranges of the same URL end with is carried over
as one row per URL and range. Bodies do not travel: results refer to the response by its id.

Input: record_id, url, ts, status (304 or a full answer), etag, last_modified, headers (a map), digest.
Defined results: full responses resolve to themselves; a null or empty url has no earlier response
(``no_response``); ties in time go by record id; of repeated record ids each row is resolved on its
own; validators that disagree give ``changed`` and no body; a revisit without validators that can be
compared gives ``unchecked`` and the body. Null headers count as none. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import stored

#: Header fields that a 304 answer updates. Fixed values (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not select a resource. Fixed values.
TRACKING = "^(utm_[^=]*|gclid|fbclid|ref)="
#: Names of a folder's own page at the path's end. ``ORACLE_SQL`` does not know them; the tables have none.
INDEX_PAGE = "/index[.](html?|php)/*$"


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment, tracking parameters or index page; sorted query."""
    parts = F.regexp_replace(url, "#.*$", "")
    scheme = F.lower(F.regexp_extract(parts, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(parts, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(host, ":(80|443)$", "")
    path = F.regexp_extract(parts, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, INDEX_PAGE, "/"), "/+$", "")
    query = F.split(F.regexp_extract(parts, "[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda q: (q != "") & ~q.rlike(TRACKING))), "&")
    joined = F.concat(scheme, F.lit("://"), host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    return F.when(host != "", joined)


def _lower_headers(headers: Column) -> Column:
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.coalesce(headers_map(entries), F.create_map().cast("map<string,string>"))


def headers_map(entries: Column) -> Column:
    """A map from (key, value) entries; of entries with one key the first counts."""
    firsts = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(firsts)


def headers_text(headers: Column) -> Column:
    """``key: value`` lines in the order of their keys."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def latest_before(rows: DataFrame, key: str, order: list[str], mark: str, value: str) -> DataFrame:
    """``rows`` with ``latest``: the ``value`` of the latest earlier row of the key where ``mark`` holds."""
    order_cols = [F.col(c) for c in order]
    laid = rows.repartitionByRange(key, *order).withColumn("part", F.spark_partition_id())
    laid = stored(laid, "revisits")  # the ranges must stay as they are for both readers
    in_part = Window.partitionBy(key, "part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col(mark), F.col(value)), ignorenulls=True)
    near = laid.withColumn("near", found.over(in_part))
    ends = laid.groupBy(key, "part").agg(
        F.max_by(value, F.when(F.col(mark), F.struct(*order_cols))).alias("end")
    )
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(key).alias("carried_key"), F.col("part").alias("carried_part"),
        F.last("end", ignorenulls=True).over(before).alias("carried"),
    ).filter("carried is not null")
    joined = near.join(
        carried, (F.col(key) == F.col("carried_key")) & (F.col("part") == F.col("carried_part")), "left"
    )
    return joined.withColumn("latest", F.coalesce("near", "carried")).drop(
        "near", "carried", "carried_key", "carried_part", "part"
    )


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """(record_id, canonical_url, base_id, outcome, status, digest, headers), one row per record."""
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "ts", "status", "etag", "last_modified",
        _lower_headers(F.col("headers")).alias("headers"), "digest",
    ).withColumn("is_full", F.col("status") != 304)
    base = F.struct("record_id", "etag", "last_modified", "headers", "digest")
    seen = latest_before(rows.withColumn("own", base), "canonical_url", ["ts", "record_id"], "is_full", "own")
    old = F.when(F.col("canonical_url").isNotNull(), F.col("latest"))
    tags = F.col("etag").isNotNull() & old["etag"].isNotNull()
    dates = F.col("last_modified").isNotNull() & old["last_modified"].isNotNull()
    agrees = F.when(tags, _weak(F.col("etag")) == _weak(old["etag"])).when(
        dates, F.col("last_modified") == old["last_modified"]
    )
    outcome = (
        F.when(F.coalesce(F.col("is_full"), F.lit(True)), "response")
        .when(old.isNull(), "no_response")
        .when(agrees, "resolved")
        .when(agrees.isNull(), "unchecked")
        .otherwise("changed")
    )
    judged = seen.withColumns({"outcome": outcome, "base": old})
    updates = F.map_filter("headers", lambda k, _: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("base.headers", lambda k, _: ~F.array_contains(F.map_keys(updates), k)), updates)
    takes = F.col("outcome").isin("resolved", "unchecked")
    return judged.select(
        "record_id",
        "canonical_url",
        F.when(F.col("outcome") == "response", F.col("record_id")).when(takes, F.col("base.record_id")).alias("base_id"),
        "outcome",
        F.when(takes, F.lit(200)).otherwise(F.col("status")).alias("status"),
        F.when(takes, F.col("base.digest")).when(F.col("outcome") == "response", F.col("digest")).alias("digest"),
        F.when(takes, merged).otherwise(F.col("headers")).alias("headers"),
    )


#: Records derived from ``pages``: a full answer for each page and, an hour later, a 304 under another
#: spelling of its url; tags and dates are missing or wrong in some.
RECORDS_SQL = """
SELECT page_id * 2 AS record_id, url, page_id * 60 AS ts, 200 AS status,
  CASE WHEN page_id % 5 <> 3 THEN concat('"', md5(html), '"') END AS etag,
  CASE WHEN page_id % 7 <> 2 THEN page_id * 60 - 1000 END AS last_modified,
  map('Content-Type', 'text/html', 'Content-Length', CAST(length(html) AS STRING),
    'Date', CAST(page_id * 60 AS STRING), 'Cache-Control', 'max-age=60') AS headers,
  md5(html) AS digest
FROM {pages} WHERE page_id IS NOT NULL
UNION ALL
SELECT page_id * 2 + 1, replace(concat(url, '#again'), 'http://', 'HTTP://'), page_id * 60 + 3600, 304,
  CASE WHEN page_id % 11 = 0 THEN '"other"' WHEN page_id % 5 <> 1 THEN concat('W/"', md5(html), '"') END,
  CASE WHEN page_id % 13 <> 0 THEN page_id * 60 - 1000 END,
  map('Date', CAST(page_id * 60 + 3600 AS STRING), 'Content-Length', '0', 'Expires', 'never'),
  NULL
FROM {pages} WHERE page_id IS NOT NULL"""

ORACLE_SQL = r"""WITH records AS (
  SELECT page_id * 2 AS record_id, url, page_id * 60 AS ts, true AS is_full,
    CASE WHEN page_id % 5 <> 3 THEN '"' || md5(html) || '"' END AS etag,
    CASE WHEN page_id % 7 <> 2 THEN page_id * 60 - 1000 END AS modified,
    md5(html) AS digest, length(html) AS n, page_id * 60 AS seen FROM pages WHERE page_id IS NOT NULL
  UNION ALL
  SELECT page_id * 2 + 1, replace(url || '#again', 'http://', 'HTTP://'), page_id * 60 + 3600, false,
    CASE WHEN page_id % 11 = 0 THEN '"other"' WHEN page_id % 5 <> 1 THEN 'W/"' || md5(html) || '"' END,
    CASE WHEN page_id % 13 <> 0 THEN page_id * 60 - 1000 END, NULL, NULL, page_id * 60 + 3600
  FROM pages WHERE page_id IS NOT NULL),
cleaned AS (SELECT *, regexp_replace(url, '#.*$', '') AS u FROM records),
named AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' ||
    regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), ':(80|443)$', '') ||
    regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS bare,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|gclid|fbclid|ref)='))), '&') AS query FROM cleaned),
keyed AS (SELECT *, bare || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical_url,
    ts * 1000000000 + record_id AS at FROM named),
full_records AS (SELECT * FROM keyed WHERE is_full),
found AS (SELECT r.*, b.record_id AS b_id, b.etag AS b_etag, b.modified AS b_modified, b.digest AS b_digest,
    b.n AS b_n, b.seen AS b_seen
  FROM (SELECT * FROM keyed WHERE NOT is_full) r ASOF LEFT JOIN full_records b
    ON r.canonical_url = b.canonical_url AND r.at > b.at),
judged AS (SELECT *, CASE WHEN b_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL AND b_etag IS NOT NULL THEN
      CASE WHEN replace(etag, 'W/', '') = b_etag THEN 'resolved' ELSE 'changed' END
    WHEN modified IS NOT NULL AND b_modified IS NOT NULL THEN
      CASE WHEN modified = b_modified THEN 'resolved' ELSE 'changed' END
    ELSE 'unchecked' END AS outcome FROM found)
SELECT record_id, canonical_url, record_id AS base_id, 'response' AS outcome, 200 AS status, digest,
  'cache-control: max-age=60' || chr(10) || 'content-length: ' || n || chr(10) || 'content-type: text/html'
    || chr(10) || 'date: ' || seen AS headers FROM full_records
UNION ALL
SELECT record_id, canonical_url, CASE WHEN outcome IN ('resolved', 'unchecked') THEN b_id END, outcome,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN 200 ELSE 304 END,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN b_digest END,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || b_n
    || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || seen || chr(10) || 'expires: never'
  ELSE 'content-length: 0' || chr(10) || 'date: ' || seen || chr(10) || 'expires: never' END
FROM judged"""
