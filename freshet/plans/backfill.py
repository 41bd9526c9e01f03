"""A new embedding model: re-embed into the other table, then switch the pointer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.config import BLUE, GREEN, JobConfig
from freshet.functions.sizes import Kept, small_side
from freshet.operators import sync
from freshet.operators.embedding import Embedder
from freshet.plans.ingest import ensure_tables, ensure_target
from freshet.sources import pointer
from freshet.sources.tables import TableStore


def reembedded(source: DataFrame, embedder: Embedder) -> DataFrame:
    """Rows of a chunk table with vectors of another model; absent fields get defaults."""
    rows = source.select(
        "doc_id",
        "chunk_id",
        F.coalesce("ordinal", F.lit(0)).alias("ordinal"),
        "text",
        F.coalesce("content_hash", F.lit("")).alias("content_hash"),
        F.coalesce("doc_content_hash", F.lit("")).alias("doc_content_hash"),
        embedder.embed(F.col("text"), "document").alias("embedding"),
        F.coalesce("source_uri", F.lit("")).alias("source_uri"),
        "metadata",
    )
    return sync.knowledge_rows(rows.withColumns({"model": F.lit(embedder.model), "dim": F.size("embedding")}))


def backfill(
    store: TableStore, embedder: Embedder, source: str | None = None, target: str | None = None, commits: int = 16
) -> dict:
    """Re-embed every chunk of `source` (the active table) into `target` (the other one of the pair).

    Rows of the target that the source lacks stay. What is left to do is decided on ids and hashes: chunks that do not
    carry the new model yet. The documents are done in `commits` parts by a hash of their id, each committed on its own,
    so a backfill that died goes on with the parts it did not reach. `processed` is the number of chunks embedded here.
    """
    ensure_tables(store)
    source = source or pointer.get_active(store)["active_collection"]
    target = target or (GREEN if source == BLUE else BLUE)
    ensure_target(store, target)
    rows, processed = store.read(source), 0
    part = F.pmod(F.xxhash64("doc_id"), F.lit(commits))
    for number in range(commits):
        with Kept() as keep:
            old = store.read(target).where(part == number)
            done = old.where(F.col("model") == embedder.model).select("chunk_id", "content_hash")
            here = rows.where(part == number)
            todo = keep(here.select("doc_id", "chunk_id", "content_hash").join(done, ["chunk_id", "content_hash"], "left_anti"))
            count = todo.count()
            if not count:
                continue
            docs = small_side(keep(todo.select("doc_id").distinct()))
            fresh = reembedded(here.join(small_side(todo.select("chunk_id")), "chunk_id", "left_semi"), embedder)
            stays = old.join(docs, "doc_id", "left_semi").join(small_side(todo.select("chunk_id")), "chunk_id", "left_anti")
            wrong = F.size("embedding") != embedder.dim
            store.replace(target, docs, stays.unionByName(fresh), {f"vectors not of size {embedder.dim}": wrong})
            processed += count
    store.maintain(target)
    return {"status": "complete", "processed": processed, "model": embedder.model, "target": target}


def cutover(
    store: TableStore, target: str = GREEN, model: str | None = None, dim: int | None = None,
    config: JobConfig = JobConfig(),
) -> dict:
    """Point searches at `target`. The other table stays, so the same call with its name rolls back."""
    ensure_target(store, target)
    row = pointer.cutover_row(target, pointer.sample_model(store.read(target)), model, dim, config)
    return pointer.set_active(store, row)
