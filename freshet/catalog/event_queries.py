"""Notifications: references, rejects, landing, triggers; also their streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog.inputs import (
    CONFIG, DOCS, DOCS_LATER, EVENTS, TREE, Derived, exploded_sql, object_uri_sql, strip_sql, windows_sql,
)
from freshet.catalog.registry import Query
from freshet.functions import text as tx
from freshet.operators import events as ev
from freshet.operators import routing
from freshet.operators.sync import latest_per_document


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EVENTS.spark(spark, sf_dir).withColumnRenamed("off", "offset")


_PARSED_SQL = f"""
ev as ({EVENTS.sql}),
v as (select off, value, try_cast(value as json) as v from ev),
e as (select off, case when (v->'$.Records') is null and (v->>'$.Message') is not null
      then try_cast((v->>'$.Message') as json) else v end as e from v),
r as (select off, unnest(json_extract(e, '$.Records[*]')) as rec,
      cast(generate_subscripts(json_extract(e, '$.Records[*]'), 1) - 1 as int) as record_no from e
      where coalesce(e->>'$.Event', '') <> 's3:TestEvent'),
f as (select off, record_no, rec->>'$.s3.bucket.name' as bucket,
      url_decode(replace(rec->>'$.s3.object.key', '+', ' ')) as key,
      trim(coalesce(rec->>'$.s3.object.eTag', ''), '"') as etag,
      coalesce(try_cast(rec->>'$.s3.object.size' as bigint), 0) as size
      from r where contains(rec->>'$.eventName', 'ObjectCreated')),
refs as (select off as "offset", record_no, bucket, key, 's3://'||bucket||'/'||key as s3_uri, etag, size,
      '' as content_type from f where bucket <> '' and key <> '')
"""


def object_refs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.object_refs(events(spark, sf_dir))


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.rejects(events(spark, sf_dir))


_OP = "case when off%7=0 then 'delete' when off%3=0 then 'replace' when off%4=0 then 'update' else 'insert' end"


def first_record_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = EVENTS.spark(spark, sf_dir).withColumn("op", F.expr(_OP)).withColumnRenamed("off", "offset")
    return ev.first_record_triggers(ev.changes(feed))


_LATEST_SQL = f"""
with {_PARSED_SQL},
k as (select ev.off, ev.value, coalesce(v->>'$.Key', case when (v->'$.Records') is null then
      (try_cast(v->>'$.Message' as json))->>'$.Key' end) as landing_key from ev join v using (off))
select landing_key, max(off) as "offset", arg_max(value, off) as value from k where landing_key is not null group by 1
"""


def latest_event_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.latest_per_key(ev.landing_key(events(spark, sf_dir)), "landing_key", ["offset"])


def latest_trigger_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = ev.object_refs(events(spark, sf_dir)).withColumn("doc_id", tx.document_id(F.col("s3_uri")))
    return latest_per_document(refs, ["offset", "record_no"]).select("doc_id", "offset", "s3_uri", "etag", "size")


def select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.select_markdown_files(TREE.spark(spark, sf_dir), "/docs/")


def route_extractor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route(DOCS.spark(spark, sf_dir)).select("key", "content_type", "extractor")


def document_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.identify(DOCS.spark(spark, sf_dir)).select("n", "source_uri", "doc_id", "doc_content_hash")


ROUTE_SQL = """case when lower(regexp_extract(key, '\\.([^.]*)$', 1)) in ('md','markdown') then 'markdown'
 when lower(regexp_extract(key, '\\.([^.]*)$', 1)) in ('pdf','csv') then lower(regexp_extract(key, '\\.([^.]*)$', 1))
 when trim(split_part(content_type, ';', 1)) = 'text/markdown' then 'markdown'
 when trim(split_part(content_type, ';', 1)) = 'application/pdf' then 'pdf'
 when trim(split_part(content_type, ';', 1)) in ('text/csv','application/csv') then 'csv' else 'text' end"""


# ---- streams --------------------------------------------------------------------------------------------------------

def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table itself, read as a stream, whether it is one file or a folder of them."""
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        # A stream reads folders only.
        return stream.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)
    return stream.parquet(path)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner, outer = EVENTS.source.exprs, EVENTS.exprs
    stream = _document_stream(spark, sf_dir).selectExpr(*inner).selectExpr(*outer)
    return stream.withColumnRenamed("off", "offset")


def _store(spark: SparkSession, name: str):
    from freshet.sources.shared import shared_dir
    from freshet.sources.tables import TableStore

    return TableStore(spark, shared_dir(spark, name))


def _folder(spark: SparkSession, name: str) -> str:
    from freshet.sources.shared import shared_dir

    return shared_dir(spark, name)


def stream_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from freshet.streaming.landing import land_stream, latest

    root = _folder(spark, "landing")
    land_stream(_event_stream(spark, sf_dir), root, f"{root}/_checkpoint").awaitTermination()
    return latest(spark, root)


# Events over three partitions, each with offsets of its own, landed in two batches: every third one comes too early or
# too late. Some have no key at all, some repeat a member name.
_PARTITIONED = Derived(
    EVENTS,
    "cast(off%3 as int) as part",
    "cast(floor(off/3) as bigint) as off_in",
    "off*1000000+(off%7)*5000000 as micros",
    "case when off%50=4 then '{\"x\":1}' when off%50=6 then '[1]' when off%50=7 then '{\"Key\":\"twice\",\"Key\":\"twice\"}' "
    "else value end as value",
    "cast(case when off%3=0 then 1 else 0 end as bigint) as batch",
)


def _partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _PARTITIONED.spark(spark, sf_dir).withColumnsRenamed({"off_in": "offset", "part": "partition"})
    return rows.withColumn("timestamp", F.timestamp_micros("micros")).drop("micros")


def _land_both(spark: SparkSession, sf_dir: str, root: str, between=lambda: None) -> None:
    from freshet.streaming.landing import land

    for number in range(2):
        land(_partitioned(spark, sf_dir).where(F.col("batch") == number).drop("batch"), root, number)
        between()


def landing_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the events of two batches went, and why some were rejected."""
    from freshet.streaming.landing import account

    root = _folder(spark, "landing")
    _land_both(spark, sf_dir, root)
    reason = [F.coalesce(F.col("reasons")[r], F.lit(0).cast("bigint")).alias(r.replace(" ", "_").lower()) for r in (
        ev.NO_JSON, ev.NO_OBJECT, ev.TEST_EVENT, ev.NO_KEY)]
    return account(spark, root).select("batch", "input", "landed", "superseded", "rejected", *reason)


def landed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed, followed after each of two landed batches."""
    from freshet.streaming.landing import follow

    root = _folder(spark, "landing")
    seen: list[str] = []

    def keep(feed: DataFrame) -> None:
        path = _folder(spark, "changes")
        feed.write.parquet(path)
        seen.append(path)

    _land_both(spark, sf_dir, root, lambda: follow(spark, root, keep, f"{root}/_feed").awaitTermination())
    return spark.read.parquet(*seen).select("landing_key", "batch", "partition", "offset", "op", "value")


_LANDED_SQL = f"""
ev as ({_PARTITIONED.sql}),
v as (select *, try_cast(value as json) as v from ev),
c as (select *, json_valid(value) as ok, starts_with(value, '{{') as obj, v->>'$.Event' as event,
      case when starts_with(value, '{{') then coalesce(v->>'$.Key', case when (v->'$.Records') is null then
      (try_cast(v->>'$.Message' as json))->>'$.Key' end) end as landing_key from v),
l as (select *, row(micros, part, off_in) as place from c where landing_key is not null)
"""


def _upload_events(stream: DataFrame, docs) -> DataFrame:
    """One notification per object of `docs`, from the documents stream."""
    if docs.where:
        stream = stream.where(docs.where)
    value = F.to_json(
        F.struct(
            F.concat_ws("/", "bucket", "key").alias("Key"),
            F.array(
                F.struct(
                    F.lit("s3:ObjectCreated:Put").alias("eventName"),
                    F.struct(
                        F.struct(F.col("bucket").alias("name")).alias("bucket"),
                        F.struct(F.col("key"), F.length("body").cast("string").alias("size")).alias("object"),
                    ).alias("s3"),
                )
            ).alias("Records"),
        )
    )
    return stream.selectExpr(*docs.exprs).select(F.col("n").alias("offset"), value.alias("value"))


def plain_chunkers():
    """Every type chunked as plain windows, so that the SQL side stays readable."""
    from freshet.operators.chunking import Chunkers, plain_pieces

    names = ("markdown", "pdf", "csv", "text")
    return Chunkers(CONFIG, {n: plain_pieces for n in names})


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two uploads of all objects, each arriving as a stream of notifications."""
    from freshet.config import BLUE
    from freshet.operators.embedding import HashedBagOfWords
    from freshet.plans.ingest import Ingest
    from freshet.streaming.ingest import ingest_landed
    from freshet.streaming.landing import land_stream

    store = _store(spark, "stream")
    ingest = Ingest(store, HashedBagOfWords(CONFIG.model, CONFIG.dim), plain_chunkers())
    for no, docs in enumerate((DOCS, DOCS_LATER)):
        objects = docs.spark(spark, sf_dir).select("bucket", "key", "content_type", "body")
        root = f"{store.root}/landing-{no}"
        feed = _upload_events(_document_stream(spark, sf_dir), docs)
        land_stream(feed, root, f"{root}/_checkpoint").awaitTermination()
        ingest_landed(spark, root, objects, ingest, f"{root}/_feed").awaitTermination()
    return store.read(BLUE).select("doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "model", "dim")


def versions_sql(docs: str) -> str:
    chunks = exploded_sql(
        f"(select *, {windows_sql('_t')} as _w from (select *, {strip_sql('body')} as _t from {object_uri_sql(docs)}))",
        "substr(sha1(source_uri),1,16) as doc_id, sha256(body) as doc_content_hash, source_uri", "_w",
    )
    return f"select *, doc_id||':'||cast(ordinal as varchar) as chunk_id, sha256(text) as content_hash from ({chunks})"


# Old rows survive when their document was not sent again, came unchanged, or came empty.
APPLIED_CTE = f"""
old as ({versions_sql(DOCS.sql)}), new as ({versions_sql(DOCS_LATER.sql)}),
fresh as (select * from new where (doc_id, doc_content_hash) not in (select (doc_id, doc_content_hash) from old)),
cnt as (select doc_id, count(*) as n from fresh group by 1),
kept as (select old.* from old left join cnt using (doc_id)
         where (n is null or ordinal < n) and chunk_id not in (select chunk_id from fresh)),
applied as (select * from kept union all by name select * from fresh)
"""


QUERIES = {
    "object_refs_from_events": Query(object_refs_from_events, f"with {_PARSED_SQL} select * from refs"),
    "event_rejects": Query(
        event_rejects,
        f"with {_PARSED_SQL}, k as (select ev.off, ev.value, v, coalesce(v->>'$.Key', case when (v->'$.Records') is null then "
        "(try_cast(v->>'$.Message' as json))->>'$.Key' end) as key from ev join v using (off)) "
        "select off as \"offset\", value, case when not json_valid(value) then 'not JSON' when not starts_with(value, '{') "
        "then 'no object' when v->>'$.Event' = 's3:TestEvent' then 'test event' else 'no key' end as reason "
        "from k where key is null",
    ),
    "landing_account": Query(
        landing_account,
        f"with {_LANDED_SQL} select batch, count(*) as input, count(distinct landing_key) as landed, "
        "count(landing_key) - count(distinct landing_key) as superseded, count(*) - count(landing_key) as rejected, "
        "count(*) filter (landing_key is null and not ok) as not_json, "
        "count(*) filter (landing_key is null and ok and not obj) as no_object, "
        "count(*) filter (landing_key is null and ok and obj and event = 's3:TestEvent') as test_event, "
        "count(*) filter (landing_key is null and ok and obj and event is distinct from 's3:TestEvent') as no_key "
        "from c group by batch",
    ),
    "landed_changes": Query(
        landed_changes,
        f"with {_LANDED_SQL}, h as (select landing_key, batch, max(place) as place from l group by all), "
        "f as (select *, max(place) over (partition by landing_key order by batch rows between unbounded preceding and 1 preceding) "
        "as known from h) select l.landing_key, l.batch, l.part as \"partition\", l.off_in as \"offset\", "
        "case when known is null then 'insert' else 'replace' end as op, value "
        "from f join l using (landing_key, batch, place) where known is null or f.place > known",
    ),
    "first_record_trigger": Query(
        first_record_trigger,
        f"with {_PARSED_SQL} select off as \"offset\", {_OP} as op, v->>'$.Records[0].s3.bucket.name' as bucket, "
        f"v->>'$.Records[0].s3.object.key' as key from v where {_OP} in ('insert','replace','update')",
    ),
    "latest_event_per_key": Query(latest_event_per_key, _LATEST_SQL),
    "latest_trigger_per_doc": Query(
        latest_trigger_per_doc,
        f"with {_PARSED_SQL}, d as (select *, substr(sha1(s3_uri),1,16) as doc_id, row_number() over "
        "(partition by s3_uri order by \"offset\" desc, record_no desc) as rn from refs) "
        'select doc_id, "offset", s3_uri, etag, size from d where rn = 1',
    ),
    "select_files": Query(
        select_files,
        f"with t as ({TREE.sql}) select path, 'docs/'||path as key, case when lower(path) like '%.md' "
        "then 'text/markdown' else 'text/markdown' end as content_type from t "
        "where regexp_matches(path, '(?i)[^/]\\.mdx?$') and not starts_with(path, '.git/')",
    ),
    "route_extractor": Query(
        route_extractor, f"select key, content_type, {ROUTE_SQL} as extractor from ({DOCS.sql})"
    ),
    "document_identity": Query(
        document_identity,
        "select n, source_uri, substr(sha1(source_uri),1,16) as doc_id, sha256(body) as doc_content_hash "
        f"from {object_uri_sql(DOCS.sql)}",
    ),
    "stream_latest_per_key": Query(stream_latest_per_key, _LATEST_SQL),
    "stream_ingest": Query(
        stream_ingest,
        f"with {APPLIED_CTE} select doc_id, chunk_id, ordinal, content_hash, doc_content_hash, "
        f"'{CONFIG.model}' as model, {CONFIG.dim} as dim from applied",
    ),
}
