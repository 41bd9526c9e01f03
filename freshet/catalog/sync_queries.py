"""Change detection, staging, upserts, checks, backfill and the pointer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog.chunk_queries import PLAIN_CHUNKS_SQL, plain_chunks
from freshet.catalog.event_queries import APPLIED_CTE, _store, plain_chunkers
from freshet.catalog.inputs import CONFIG, DIM, DOCS, DOCS_LATER, Derived, object_uri_sql, table
from freshet.catalog.registry import Query
from freshet.config import BLUE, GREEN
from freshet.functions.sizes import small_side
from freshet.functions.windows import windows
from freshet.operators import checks, sync
from freshet.operators.chunking import chunk_documents
from freshet.operators.embedding import HashedBagOfWords
from freshet.operators.routing import identify
from freshet.plans.backfill import reembedded
from freshet.plans.ingest import Ingest
from freshet.sources import pointer


def documents(spark: SparkSession, sf_dir: str, docs: Derived) -> DataFrame:
    return plain_chunkers().route(identify(docs.spark(spark, sf_dir)))


def chunks(spark: SparkSession, sf_dir: str, docs: Derived) -> DataFrame:
    return chunk_documents(documents(spark, sf_dir, docs), plain_chunkers())


def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    knowledge = chunks(spark, sf_dir, DOCS)
    later = documents(spark, sf_dir, DOCS_LATER)
    count = F.size(windows(F.col("body"), CONFIG.chunk_size, CONFIG.chunk_overlap))
    return sync.ingest_plan(later, knowledge, count)


_PLAN_SQL = f"""
with {APPLIED_CTE},
docs as (select substr(sha1(source_uri),1,16) as doc_id, sha256(body) as doc_content_hash from {object_uri_sql(DOCS_LATER.sql)}),
n as (select doc_id, cast(count(*) as int) as n from new group by 1)
select doc_id, doc_content_hash,
 case when (doc_id, doc_content_hash) in (select (doc_id, doc_content_hash) from old) then 'unchanged'
      when n is null then 'empty' else 'staged' end as status,
 case when (doc_id, doc_content_hash) in (select (doc_id, doc_content_hash) from old) then 0 else coalesce(n, 0) end as n
from docs left join n using (doc_id)
"""


def _changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    later = documents(spark, sf_dir, DOCS_LATER)
    changed = small_side(sync.changed_versions(later, chunks(spark, sf_dir, DOCS)).persist())
    return changed, chunk_documents(sync.changed_documents(later, changed), plain_chunkers())


def staging_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging that still holds the first upload, after staging what changed in the second."""
    changed, new_rows = _changed(spark, sf_dir)
    return sync.replace_staging(chunks(spark, sf_dir, DOCS), changed, new_rows).select(
        "doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "status"
    )


# Progress of an interrupted embedding run: some chunks done with this model, some with an older one, some not at all.
_PROGRESS = "case when ordinal%2=0 then 'embedded' else 'pending' end"
_PROGRESS_MODEL = f"case when ordinal%2=1 then null when ordinal%4=0 then '{CONFIG.model}' else 'older' end"


def _interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = plain_chunks(spark, sf_dir)
    return staged.withColumns({"status": F.expr(_PROGRESS), "model": F.expr(_PROGRESS_MODEL)})


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.needs_embedding(_interrupted(spark, sf_dir), CONFIG.model).select("chunk_id", "status", "model")


def mark_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors that were missing arrive; chunks of a document in ordinal order."""
    staged = _interrupted(spark, sf_dir)
    missing = sync.needs_embedding(staged, CONFIG.model)
    vectors = missing.select(
        "chunk_id",
        HashedBagOfWords(CONFIG.model, DIM).embed(F.col("text")).alias("embedding"),
        F.lit(CONFIG.model).alias("model"),
        F.lit(DIM).alias("dim"),
    )
    marked = sync.mark_embedded(staged, vectors)
    return marked.where(F.col("status") == "embedded").select("doc_id", "ordinal", "chunk_id", "status", "model")


def knowledge_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed, new_rows = _changed(spark, sf_dir)
    applied = small_side(new_rows.select("doc_id").distinct().persist())
    after = sync.apply_documents(
        sync.knowledge_rows(chunks(spark, sf_dir, DOCS)), applied, sync.knowledge_rows(new_rows)
    )
    return after.select("doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "source_uri")


def stale_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the tail that a shorter version leaves behind is removed; empty versions remove nothing."""
    changed, new_rows = _changed(spark, sf_dir)
    counts = small_side(new_rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).persist())
    return sync.prune_stale(chunks(spark, sf_dir, DOCS), counts).select("doc_id", "chunk_id", "ordinal", "content_hash")


def ingest_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "ingest")
    ingest = Ingest(store, HashedBagOfWords(CONFIG.model, DIM), plain_chunkers())
    for docs in (DOCS, DOCS_LATER):
        ingest.run(docs.spark(spark, sf_dir).select("bucket", "key", "content_type", "body"))
    return store.read(BLUE).select(
        "doc_id", "chunk_id", "ordinal", "content_hash", "doc_content_hash", "source_uri", "model", "dim",
        F.size("embedding").alias("vector_size"),
    )


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and chunks by outcome of the second upload."""
    plan = ingest_plan(spark, sf_dir)
    return plan.groupBy("status").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").cast("bigint").alias("chunks")
    )


def unique_chunk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table into which both uploads were put without an upsert breaks the constraint."""
    both = chunks(spark, sf_dir, DOCS).select("chunk_id").union(chunks(spark, sf_dir, DOCS_LATER).select("chunk_id"))
    return checks.duplicate_chunk_ids(both)


def dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), "embedding", F.expr("case when label=3 then 32 else 64 end").alias("dim")
    )
    return checks.wrong_dimensions(vectors, 64)


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.page_after(plain_chunks(spark, sf_dir).select("chunk_id", "content_hash"), "8", 50)


# One pointer per source, as tenants would have: the data decides which of the pair is active.
_POINTERS_SQL = (
    f"select source, case when sum(n_chars)%2=0 then '{BLUE}' else '{GREEN}' end as active_collection "
    "from documents group by source"
)


def backfill_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    pointers = (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(F.expr(f"case when sum(n_chars)%2=0 then '{BLUE}' else '{GREEN}' end").alias("active_collection"))
    )
    return pointers.withColumn("target", pointer.other_table(F.col("active_collection")))


_MODEL_OF_LANG = "case lang when 'de' then 'm-de' when 'en' then 'm-en' when 'es' then 'm-es' else 'm-fr' end"


def _modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.expr("sha1(cast(doc_id as string))").alias("chunk_id"), F.expr(_MODEL_OF_LANG).alias("model"),
        F.length("lang").alias("dim"),
    )


def cutover_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pointer.cutover_row(GREEN, pointer.sample_model(_modelled(spark, sf_dir)), config=CONFIG)


def rollback_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back to the first table: its sample gives the model, the operator gives the dimension."""
    return pointer.cutover_row(BLUE, pointer.sample_model(_modelled(spark, sf_dir)), dim=128, config=CONFIG)


_CUTOVER_SQL = f"""
with m as (select sha1(cast(doc_id as varchar)) as chunk_id, {_MODEL_OF_LANG} as model, length(lang) as dim from documents)
select '%s' as active_collection, '{CONFIG.index_name}' as active_index, arg_min(model, chunk_id) as model, %s as dim from m
"""


def backfill_reembed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first upload re-embedded into a table that already holds part of the second one."""
    source = sync.knowledge_rows(chunks(spark, sf_dir, DOCS))
    target = sync.knowledge_rows(chunks(spark, sf_dir, DOCS_LATER).withColumn("model", F.lit("older")))
    after = sync.upsert(target, reembedded(source, HashedBagOfWords("hashed-bow-2", 32)))
    return after.select("chunk_id", "ordinal", "content_hash", "doc_content_hash", "model", "dim")


_REEMBED_SQL = f"""
with {APPLIED_CTE}
select chunk_id, ordinal, content_hash, doc_content_hash, 'hashed-bow-2' as model, 32 as dim from old
union all select chunk_id, ordinal, content_hash, doc_content_hash, 'older', null from new
where chunk_id not in (select chunk_id from old)
"""


_PROGRESS_SQL = f"with c as (select *, {_PROGRESS} as status, {_PROGRESS_MODEL} as model from ({PLAIN_CHUNKS_SQL}))"

QUERIES = {
    "ingest_plan": Query(ingest_plan, _PLAN_SQL),
    "ingest_report": Query(
        ingest_report,
        f"select status, count(*) as documents, cast(sum(n) as bigint) as chunks from ({_PLAN_SQL}) group by status",
    ),
    "staging_replace": Query(
        staging_replace,
        f"with {APPLIED_CTE}, docs as (select substr(sha1(source_uri),1,16) as doc_id, sha256(body) as h from "
        f"{object_uri_sql(DOCS_LATER.sql)}), ch as (select doc_id from docs where (doc_id, h) not in "
        "(select (doc_id, doc_content_hash) from old)) "
        "select doc_id, chunk_id, ordinal, content_hash, doc_content_hash, 'pending' as status from ("
        "select * from old where doc_id not in (from ch) union all by name select * from fresh)",
    ),
    "resume_pending": Query(
        resume_pending,
        f"{_PROGRESS_SQL} select chunk_id, status, model from c where not (status='embedded' and "
        f"coalesce(model,'')='{CONFIG.model}')",
    ),
    "mark_embedded": Query(
        mark_embedded,
        f"{_PROGRESS_SQL} select doc_id, ordinal, chunk_id, 'embedded' as status, '{CONFIG.model}' as model from c",
    ),
    "knowledge_apply": Query(
        knowledge_apply,
        f"with {APPLIED_CTE} select doc_id, chunk_id, ordinal, content_hash, doc_content_hash, source_uri from applied",
    ),
    "stale_prune": Query(
        stale_prune,
        f"with {APPLIED_CTE} select doc_id, chunk_id, ordinal, content_hash from old left join cnt using (doc_id) "
        "where n is null or ordinal < n",
    ),
    "ingest_end_to_end": Query(
        ingest_end_to_end,
        f"with {APPLIED_CTE} select doc_id, chunk_id, ordinal, content_hash, doc_content_hash, source_uri, "
        f"'{CONFIG.model}' as model, {DIM} as dim, {DIM} as vector_size from applied",
    ),
    "unique_chunk_check": Query(
        unique_chunk_check,
        f"with {APPLIED_CTE} select chunk_id, count(*) as copies from (select chunk_id from old union all "
        "select chunk_id from new) group by 1 having count(*) > 1",
    ),
    "dim_check": Query(
        dim_check,
        "select vec_id as chunk_id, 32 as dim, cast(len(embedding) as int) as vector_size from embeddings where label=3",
    ),
    "page_scan": Query(
        page_scan,
        f"select chunk_id, content_hash from ({PLAIN_CHUNKS_SQL}) where chunk_id > '8' order by chunk_id limit 50",
    ),
    "backfill_target": Query(
        backfill_target,
        f"select *, case when active_collection='{BLUE}' then '{GREEN}' else '{BLUE}' end as target from ({_POINTERS_SQL})",
    ),
    "cutover_pointer": Query(cutover_pointer, _CUTOVER_SQL % (GREEN, "cast(arg_min(dim, chunk_id) as int)")),
    "rollback_pointer": Query(rollback_pointer, _CUTOVER_SQL % (BLUE, "128")),
    "backfill_reembed": Query(backfill_reembed, _REEMBED_SQL),
}
