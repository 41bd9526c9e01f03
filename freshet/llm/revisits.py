"""Not-modified revisits of web archives, resolved to the full responses that they stand for.

A crawler that gets "304 Not Modified" writes a revisit record without a body. It stands for the latest earlier full
response of the same address, if their validators agree. The join is as of the revisit's time, by canonical URL.

The records of one URL may be a third of all. So they are not gathered by URL: records are put in the order of (URL,
time, id) by range, which cuts a hot URL into many ranges. Inside a range a window finds the latest earlier response;
the first records of a URL in a range take it from the ranges before, of which only one row per URL and range is looked
at. Only ids, times and validators take part; headers and bodies are fetched for the pairs found, by record id.

Times are compared first, then record ids; a response of the same time and a smaller id is earlier. Validators agree if
the entity tags do, compared weakly (a W/ in front is ignored), or, where one of the two has no tag, if the times of
last modification are equal. Without any common validator the payload digest decides; without one on both sides too
the pair is "unchecked". status tells: resolved, unchecked, mismatch (validators differ), orphan (no earlier response).
Merged headers are those of the response, of which the PERMITTED ones are replaced by those of the revisit, as a cache
updates a stored response. Names are compared in lower case; of repeated names the last wins.

Defined results: revisits without a URL or time are orphans; responses without them are never found. Null or empty
headers are no headers. Repeated rows with the same id count as one record, the smallest by content. An empty table gives
an empty table. Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import read, written

# Header fields that a 304 response may update in the stored response (RFC 9110, 15.4.5), in lower case. Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that do not change what an address shows. Fixed values.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, fragment, tracking parameters or final slash; query sorted."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    rest = F.substr(bare, F.length(head) + 1, F.length(bare))
    head = F.regexp_replace(F.regexp_replace(head, r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_extract(p, "^([^=]*)", 1).isin(*TRACKING))
    )
    return F.concat(head, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _tag(tag: Column) -> Column:
    return F.nullif(F.regexp_replace(F.trim(tag), "^W/", ""), F.lit(""))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with the permitted ones of the fresh ones in their place. Maps of lower-case names."""
    none = F.create_map().cast("map<string,string>")
    allowed = F.map_filter(F.coalesce(fresh, none), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce(stored, none), lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def headers_of(pairs: Column) -> Column:
    """A map of lower-case names from an array of structs (name, value); the last of repeated names wins."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    named = F.filter(F.coalesce(pairs, none), lambda p: p["name"].isNotNull())
    lower = F.transform(named, lambda p: F.struct(F.lower(p["name"]).alias("name"), p["value"].alias("value")))
    last = F.filter(
        F.transform(lower, lambda p, i: F.struct(p["name"].alias("name"), p["value"].alias("value"), i.alias("i"))),
        lambda p: F.array_position(F.reverse(F.transform(lower, lambda q: q["name"])), p["name"]) == F.size(lower) - p["i"],
    )
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["name"], p["value"])))


def latest_earlier(records: DataFrame) -> DataFrame:
    """(record_id, response_id) of the revisits in `records` (record_id, url, ts, full) that have an earlier response."""
    # A written table, so that ranges are the same wherever it is read.
    ranged = written(
        records.where("url is not null and ts is not null")
        .select("record_id", F.xxhash64("url").alias("_h"), "url", "ts", "full")
        .repartitionByRange("_h", "url", "ts", "record_id")
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    mine = F.when(F.col("full"), F.col("record_id"))
    before = Window.partitionBy("_range", "url").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.last(mine, ignorenulls=True).over(before))
    # The last response of each URL in each range, handed on to later ranges.
    last = ranged.groupBy("_range", "url").agg(F.max(F.when(F.col("full"), F.struct("ts", "record_id"))).alias("_last"))
    ranges = Window.partitionBy("url").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("_range", "url", F.last("_last.record_id", ignorenulls=True).over(ranges).alias("_handed"))
    handed = handed.where("_handed is not null")
    return (
        inside.where(~F.col("full"))
        .join(handed, ["_range", "url"], "left")
        .select("record_id", F.coalesce("_inside", "_handed").alias("response_id"))
        .where("response_id is not null")
    )


def resolved(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url, ts, response_id, status, headers, payload_digest and body.

    `records`: record_id, url, ts, kind ("response" or "revisit"), http_status, etag, last_modified, payload_digest,
    headers (array of name and value) and body. Full responses are those of kind response with a status of 200 to 299.
    """
    slim = ("record_id", "url", "ts", "full", "etag", "last_modified", "payload_digest")
    known = records.where("record_id is not null").select(
        "record_id",
        canonical_url(F.col("url")).alias("url"),
        "ts",
        ((F.col("kind") == "response") & F.col("http_status").between(200, 299)).alias("full"),
        (F.col("kind") == "revisit").alias("_revisit"),
        _tag(F.col("etag")).alias("etag"),
        F.nullif(F.trim("last_modified"), F.lit("")).alias("last_modified"),
        "payload_digest",
    )
    known = known.where("full or _revisit").withColumn("full", F.coalesce("full", F.lit(False)))
    one = known.groupBy("record_id").agg(F.min(F.struct(*[c for c in slim if c != "record_id"])).alias("r"))
    known = written(one.select("record_id", "r.*"), "records")
    pairs = latest_earlier(known)
    revisits = known.where(~F.col("full"))
    response = known.where("full").select(
        F.col("record_id").alias("response_id"), *[F.col(c).alias(f"_{c}") for c in ("etag", "last_modified", "payload_digest")]
    )
    agrees = (
        F.when(F.col("etag").isNotNull() & F.col("_etag").isNotNull(), F.col("etag") == F.col("_etag"))
        .when(F.col("last_modified").isNotNull() & F.col("_last_modified").isNotNull(), F.col("last_modified") == F.col("_last_modified"))
        .otherwise(F.col("payload_digest") == F.col("_payload_digest"))
    )
    status = (
        F.when(F.col("response_id").isNull(), "orphan").when(agrees, "resolved").when(~agrees, "mismatch").otherwise("unchecked")
    )
    # A response may be what very many revisits point to; its slim row is joined, and the join splits a hot one.
    judged = (
        revisits.join(pairs, "record_id", "left")
        .join(response, "response_id", "left")
        .select("record_id", "url", "ts", "response_id", status.alias("status"), F.col("_payload_digest").alias("payload_digest"))
    )
    judged = written(judged, "judged")
    # Headers of the revisit by its own id, headers and body of the response by the one found.
    # Of repeated rows with one id the smallest content counts.
    every = records.where("record_id is not null")
    fresh = every.where("kind = 'revisit'").groupBy("record_id").agg(F.min("headers").alias("_fresh"))
    stored = (
        every.where("kind = 'response' and http_status between 200 and 299")
        .groupBy("record_id")
        .agg(F.min(F.struct("headers", "body")).alias("_stored"))
        .withColumnRenamed("record_id", "response_id")
    )
    found = F.col("status").isin("resolved", "unchecked")
    return (
        judged.join(fresh, "record_id", "left")
        .join(stored, "response_id", "left")
        .select(
            "record_id", "url", "ts", "response_id", "status",
            F.when(found, merged_headers(headers_of(F.col("_stored.headers")), headers_of(F.col("_fresh")))).alias("headers"),
            F.when(found, F.col("payload_digest")).alias("payload_digest"),
            F.when(found, F.col("_stored.body")).alias("body"),
        )
    )


# Records made from the pages, read by both engines: every page was fetched once in full, and asked for again twice. Of
# the later fetches some found the page changed, some carry other validators, some have none, some came before.
_FETCHED = "cast(page_id * 7919 % 100003 as bigint)"
_URL = "url||case when page_id % 3 = 1 then '#again' else '' end"
RECORDS = (
    f"select page_id * 4 as record_id, url, {_FETCHED} as ts, 'response' as kind, "
    "case when page_id % 17 = 0 then 404 else 200 end as http_status, "
    "case when page_id % 5 = 0 then cast(null as string) else md5(html) end as etag, "
    "case when page_id % 10 = 0 then '' else cast(page_id % 1000 as string) end as last_modified, "
    "md5(html) as payload_digest, 'text/html' as content_type, cast(page_id as string) as date_header, html as body from pages",
    f"select page_id * 4 + 1, {_URL}, {_FETCHED} + 50, 'revisit', 304, "
    "case when page_id % 7 = 0 then 'other' when page_id % 5 = 1 then 'W/'||md5(html) else md5(html) end, "
    "case when page_id % 11 = 0 then 'never' else cast(page_id % 1000 as string) end, "
    "case when page_id % 10 = 0 then cast(null as string) else md5(html) end, 'text/plain', 'again', cast(null as string) from pages",
    f"select page_id * 4 + 2, {_URL}, {_FETCHED} + case when page_id % 4 = 0 then -100 else 100 end, 'revisit', 304, "
    "cast(null as string), cast(null as string), md5(html), 'text/plain', 'later', cast(null as string) from pages",
    f"select page_id * 4 + 3, url, {_FETCHED} + 70, 'response', 200, 'new'||cast(page_id as string), 'now', "
    "'changed', 'text/html', 'changed', 'changed' from pages where page_id % 6 = 0",
)


def op5_not_modified_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    records = spark.sql(" union all ".join(r.replace("from pages", "from {pages}") for r in RECORDS), pages=pages)
    pair = lambda name, column: F.struct(F.lit(name).alias("name"), F.col(column).alias("value"))
    records = records.withColumn(
        "headers", F.array(pair("Content-Type", "content_type"), pair("Date", "date_header"), pair("ETag", "etag"))
    )
    found = resolved(records)
    return found.select(
        "record_id", "url", "ts", "response_id", "status", "payload_digest",
        F.element_at("headers", "content-type").alias("content_type"),
        F.element_at("headers", "date").alias("date_header"),
        F.element_at("headers", "etag").alias("etag"),
        F.md5("body").alias("body_md5"),
    )


_NAMES = "record_id, url, ts, kind, http_status, etag, last_modified, payload_digest, content_type, date_header, body"
SQL = f"""
with records({_NAMES}) as ({" union all ".join(RECORDS)}),
bare as (select *, regexp_replace(trim(url), '#.*$', '') as b from records),
cut as (select *, lower(regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) as head from bare),
cut2 as (select *, substr(b, length(head) + 1) as rest from cut),
canon as (select * exclude (url), regexp_replace(regexp_replace(head, '^(http://.*):80$', '\\1'), '^(https://.*):443$', '\\1')
  || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '')
  || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as url,
  nullif(regexp_replace(trim(etag), '^W/', ''), '') as tag, nullif(trim(last_modified), '') as modified,
  kind = 'response' and http_status between 200 and 299 as is_full
  from (select *, list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
    lambda p: p <> '' and regexp_extract(p, '^([^=]*)', 1) not in ({", ".join(f"'{t}'" for t in TRACKING)}))) as q from cut2)),
found as (select r.*, (select arg_max(s.record_id, (s.ts, s.record_id)) from canon s where s.is_full and s.url = r.url
  and (s.ts, s.record_id) < (r.ts, r.record_id)) as response_id from canon r where r.kind = 'revisit'),
judged as (select f.*, s.etag as s_etag, s.payload_digest as s_digest, s.content_type as s_type, s.date_header as s_date, s.body as s_body,
  case when f.tag is not null and s.tag is not null then f.tag = s.tag
    when f.modified is not null and s.modified is not null then f.modified = s.modified
    else f.payload_digest = s.payload_digest end as agrees
  from found f left join canon s on s.record_id = f.response_id),
told as (select *, case when response_id is null then 'orphan' when agrees then 'resolved' when not agrees then 'mismatch'
  else 'unchecked' end as status from judged)
select record_id, url, ts, response_id, status,
  case when status in ('resolved', 'unchecked') then s_digest end as payload_digest,
  case when status in ('resolved', 'unchecked') then s_type end as content_type,
  case when status in ('resolved', 'unchecked') then date_header end as date_header,
  case when status in ('resolved', 'unchecked') then etag end as etag,
  case when status in ('resolved', 'unchecked') then md5(s_body) end as body_md5
from told"""
