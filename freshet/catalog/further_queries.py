"""Inline records, row sync, sensor batches, re-sync and tenants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog.event_queries import APPLIED_CTE, _store, plain_chunkers, versions_sql
from freshet.catalog.inputs import CONFIG, DIM, DOCS, DOCS_LATER, object_uri_sql, table
from freshet.catalog.registry import Query
from freshet.catalog.sync_queries import chunks, documents
from freshet.config import BLUE
from freshet.operators import extras, sync
from freshet.operators.chunking import Chunkers, chunk_documents, text_pieces
from freshet.operators.embedding import HashedBagOfWords
from freshet.plans.ingest import Ingest
from freshet.plans.rows import sync_rows
from freshet.plans.tenants import TENANT_REPORT, TENANTS, TenantIngest
from freshet.sources.snapshots import Snapshots


def _order_columns(orders: DataFrame, status: str = "o_orderstatus") -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", F.expr(status).alias("o_orderstatus"), "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


_ROW_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "cents"]


def _row_json_sql(status: str = "o_orderstatus") -> str:
    return (
        "'{\"o_orderkey\":'||o_orderkey||',\"o_custkey\":'||o_custkey||',\"o_orderstatus\":\"'||" + status +
        "||'\",\"o_orderpriority\":\"'||o_orderpriority||'\",\"cents\":'||cast(round(o_totalprice*100) as bigint)||'}'"
    )


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a database and readings of a device as inline records, chunked as JSON texts."""
    orders = extras.row_documents(_order_columns(table(spark, sf_dir, "orders")), "rdbms", "o_orderkey", _ROW_COLUMNS)
    readings = extras.inline_documents(
        extras.inline_records(
            table(spark, sf_dir, "events"), "iot", F.col("event_id").cast("string"), F.col("props"), topic="events"
        )
    )
    return chunk_documents(orders.unionByName(readings), Chunkers()).select(
        "doc_id", "chunk_id", "ordinal", "text", "doc_content_hash", "source_uri"
    )


def _pretty_sql(json: str) -> str:
    # flat objects only: one member per line
    step = f"replace(replace({json}, '{{\"', '{{'||chr(10)||'  \"'), '}}', chr(10)||'}}')"
    return f"replace(replace({step}, ',\"', ','||chr(10)||'  \"'), '\":', '\": ')"


_PAYLOAD_SQL = f"""
with r as (select 'rdbms://'||cast(o_orderkey as varchar) as source_uri, {_row_json_sql()} as p from orders
 union all select 'iot://'||cast(event_id as varchar), replace(props, ': ', ':') from events),
e as (select 'iot://'||cast(event_id as varchar) as source_uri, props from events)
select substr(sha1(r.source_uri),1,16) as doc_id, substr(sha1(r.source_uri),1,16)||':0' as chunk_id, 0 as ordinal,
 {_pretty_sql('p')} as text, sha256(coalesce(e.props, p)) as doc_content_hash, r.source_uri
from r left join e using (source_uri)
"""

_LATER_STATUS = "case when o_orderstatus = 'P' then 'F' else o_orderstatus end"


def row_hash_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which table rows need indexing again after all pending orders were fulfilled."""
    orders = table(spark, sf_dir, "orders")
    before = extras.row_documents(_order_columns(orders), "orders", "o_orderkey", _ROW_COLUMNS)
    after = extras.row_documents(_order_columns(orders, _LATER_STATUS), "orders", "o_orderkey", _ROW_COLUMNS)
    return sync.changed_versions(after, before)


_ROW_SYNC_SQL = f"""
select substr(sha1('orders://'||cast(o_orderkey as varchar)),1,16) as doc_id,
 sha256({_row_json_sql(_LATER_STATUS)}) as doc_content_hash from orders where o_orderstatus = 'P'
"""


# Two states of the orders table: one in eleven is not there yet at first, one in seven is gone later.
_FIRST, _LATER = "o_orderkey % 11 <> 0", "o_orderkey % 7 <> 0"


def _synced_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The report of the second sync, and the index after it."""
    store = _store(spark, "rows")
    ingest = Ingest(store, HashedBagOfWords(CONFIG.model, DIM), Chunkers(CONFIG, {"text": text_pieces}))
    snapshots = Snapshots(spark, f"{store.root}/snapshots")
    orders = table(spark, sf_dir, "orders")
    for rows in (
        _order_columns(orders.where(_FIRST)),
        _order_columns(orders.where(_LATER), _LATER_STATUS),
    ):
        report = sync_rows(ingest, snapshots, rows, "orders", "o_orderkey", _ROW_COLUMNS)
    return report, store.read(BLUE)


def ingest_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a database in the index after a second sync: inserted, revised and deleted rows are followed."""
    return _synced_orders(spark, sf_dir)[1].select(
        "doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "source_uri", "model", "dim"
    )


def ingest_inline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second sync found changed."""
    return _synced_orders(spark, sf_dir)[0]


_INLINE_SQL = f"""
with o as (select 'orders://'||cast(o_orderkey as varchar) as source_uri, {_row_json_sql(_LATER_STATUS)} as p from orders where {_LATER})
select substr(sha1(source_uri),1,16) as doc_id, substr(sha1(source_uri),1,16)||':0' as chunk_id, 0 as ordinal,
 sha256({_pretty_sql('p')}) as content_hash, sha256(p) as doc_content_hash, source_uri, '{CONFIG.model}' as model, {DIM} as dim from o
"""

_INLINE_REPORT_SQL = f"""
select substr(sha1('orders://'||cast(o_orderkey as varchar)),1,16) as doc_id,
 case when not ({_LATER}) then 'delete' when not ({_FIRST}) then 'insert' else 'update' end as change,
 case when {_LATER} then 1 else 0 end as indexed
from orders where ({_FIRST} and not ({_LATER})) or ({_LATER} and not ({_FIRST})) or ({_FIRST} and {_LATER} and o_orderstatus = 'P')
"""


def resync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full listing below one prefix, checked against what is indexed: everything else is left alone."""
    listed = documents(spark, sf_dir, DOCS).where(F.col("key").startswith("en/"))
    indexed = chunks(spark, sf_dir, DOCS).where(~F.col("source_uri").like("%.txt"))
    return sync.changed_versions(listed, indexed)


def tenant_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks per tenant table; the bucket is the tenant."""
    routed = chunk_documents(documents(spark, sf_dir, DOCS), plain_chunkers())
    tenant = F.regexp_extract("source_uri", "^s3://([^/]+)/", 1)
    return (
        routed.withColumn("target", extras.tenant_target(tenant))
        .groupBy("target")
        .agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("chunks"))
    )


def _tenants(spark: SparkSession, sf_dir: str):
    """East gets all documents, west the Spanish ones as well; then east gets the later upload, and at last the Spanish
    ones as they were at first."""
    ingest = TenantIngest(_store(spark, "tenants"), HashedBagOfWords(CONFIG.model, DIM), plain_chunkers())
    first, later = DOCS.spark(spark, sf_dir), DOCS_LATER.spark(spark, sf_dir)
    spanish = first.where("lang = 'es'")
    east, west = (F.lit(n).alias("target") for n in ("east", "west"))
    for objects in (first.select("*", east).unionByName(spanish.select("*", west)), later.select("*", east), spanish.select("*", east)):
        ingest.run(objects)
    return ingest.store


def tenant_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tenants in one table after three ingests: documents that both hold, and versions that came back."""
    return _tenants(spark, sf_dir).read(TENANTS).select(
        "target", "doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "source_uri", "model", "dim"
    )


def tenant_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ingest of the versions that came back did."""
    return _tenants(spark, sf_dir).read(TENANT_REPORT)


_SPANISH = "source_uri like 's3://%/es/%'"
_TENANT_SQL = f"""
with {APPLIED_CTE}, held as (
 select 'east' as target, * from applied where not {_SPANISH} union all by name
 select 'east' as target, * from old where {_SPANISH} union all by name
 select 'west' as target, * from old where {_SPANISH})
select target, doc_id, chunk_id, ordinal, content_hash, doc_content_hash, source_uri, '{CONFIG.model}' as model, {DIM} as dim from held
"""

_TENANT_REPORT_SQL = f"""
with {APPLIED_CTE},
docs as (select substr(sha1(source_uri),1,16) as doc_id, sha256(body) as h, lower(regexp_extract(key, '[.]([A-Za-z]+)$', 1)) as ext,
 content_type from {object_uri_sql(DOCS.sql)} where lang = 'es'),
size as (select doc_id, cast(count(*) as int) as n from old group by 1),
held as (select distinct doc_id, doc_content_hash as h from applied),
told as (select doc_id, case when (doc_id, h) in (select (doc_id, h) from held) then 'unchanged' when n is null then 'empty'
 else 'indexed' end as status, n, case when ext = 'md' or content_type like 'text/markdown%' then 'markdown'
 when content_type = 'application/pdf' then 'pdf' else 'text' end as kind from docs left join size using (doc_id))
select 'east' as target, doc_id, status, case when status = 'indexed' then n else 0 end as indexed,
 case when status = 'indexed' then 'east' end as collection, case when status = 'indexed' then kind end as extractor from told
"""


def readings_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = extras.count_readings(table(spark, sf_dir, "events"), "1 hour", ["event_type"])
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def sensor_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of six hours per record, at most 1000 numbers apart."""
    batches = extras.batch_readings(table(spark, sf_dir, "events"), "6 hours", ["event_type"], "event_id", F.col("props"))
    return batches.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


QUERIES = {
    "payload_records": Query(payload_records, _PAYLOAD_SQL),
    "row_hash_sync": Query(row_hash_sync, _ROW_SYNC_SQL),
    "ingest_inline": Query(ingest_inline, _INLINE_SQL),
    "ingest_inline_report": Query(ingest_inline_report, _INLINE_REPORT_SQL),
    "resync_plan": Query(
        resync_plan,
        f"with old as ({versions_sql(DOCS.sql)}), docs as (select *, substr(sha1(source_uri),1,16) as doc_id, "
        f"sha256(body) as doc_content_hash from {object_uri_sql(DOCS.sql)} where starts_with(key, 'en/')) "
        "select doc_id, doc_content_hash from docs where (doc_id, doc_content_hash) not in "
        "(select (doc_id, doc_content_hash) from old where source_uri not like '%.txt')",
    ),
    "tenant_route": Query(
        tenant_route,
        f"select regexp_extract(source_uri, '^s3://([^/]+)/', 1)||'_knowledge' as target, "
        f"count(distinct doc_id) as documents, count(*) as chunks from ({versions_sql(DOCS.sql)}) group by 1",
    ),
    "tenant_ingest": Query(tenant_ingest, _TENANT_SQL),
    "tenant_ingest_report": Query(tenant_ingest_report, _TENANT_REPORT_SQL),
    "readings_tumbling": Query(
        readings_tumbling,
        "select event_type, time_bucket(interval 1 hour, ts) as window_start, count(*) as readings from events group by all",
    ),
    "sensor_batches": Query(
        sensor_batches,
        "select event_type, time_bucket(interval 6 hour, ts) as window_start, event_id//1000 as part, count(*) as readings, "
        "string_agg(props, chr(10) order by event_id) as payload from events group by all",
    ),
}
