"""Documents to searchable chunks: detect changes, stage, embed, apply.

Each step commits its table before the next one starts, so a job that dies is simply run again: staged documents are
not chunked twice, embedded chunks are not embedded twice, and applied documents come out as unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas
from freshet.config import BLUE, GREEN, REPORT, STAGING
from freshet.functions.sizes import KEY_ROWS, SLIM_ROWS, Kept, at_most, likely, small_side
from freshet.operators import checks, extras, sync
from freshet.operators.chunking import Chunkers, chunk_documents
from freshet.operators.embedding import Embedder, HashedBagOfWords, embed_chunks
from freshet.operators.routing import identify
from freshet.sources.pointer import get_active
from freshet.sources.shared import free_shuffles
from freshet.sources.tables import TableStore


def ensure_tables(store: TableStore) -> list[str]:
    """Create the tables that do not exist yet; chunk tables are bucketed by document and sorted for lookups."""
    wanted = {STAGING: schemas.STAGING, BLUE: schemas.KNOWLEDGE, GREEN: schemas.KNOWLEDGE}
    made = [n for n, schema in wanted.items() if store.ensure(n, schema, "doc_id", ("doc_id", "ordinal"))]
    return made + ([REPORT] if store.ensure(REPORT, schemas.INGEST_REPORT) else [])


def ensure_target(store: TableStore, name: str) -> bool:
    return store.ensure(name, schemas.KNOWLEDGE, "doc_id", ("doc_id", "ordinal"))


@dataclass
class Ingest:
    """`prune_empty` also removes the chunks of a document whose new version is empty; by default they stay. `commits`
    is the number of parts in which embeddings are committed. Vectors of another size than the embedder's and repeated
    chunk ids stop an ingest before its rows are seen by anyone."""

    store: TableStore
    embedder: Embedder = field(default_factory=HashedBagOfWords)
    chunkers: Chunkers = field(default_factory=Chunkers)
    prune_empty: bool = False
    commits: int = 1

    def run(self, objects: DataFrame, target: str | None = None) -> DataFrame:
        """Ingest objects (bucket, key, content_type, body; pages for paged types), one row per object.

        Returns the report of this run, also kept as a table: doc_id, status (unchanged, empty, missing, indexed),
        indexed, collection, extractor. `target` is the table to write, "active" the one searched at the moment. A
        version counts as known if that table holds it. Of several rows for one object the one with the largest
        version hash is taken. Objects without a body are missing: nothing of theirs changes.
        """
        return self.run_documents(self.chunkers.route(identify(objects)), target)

    def run_records(self, raw: DataFrame, fetch: Callable[[DataFrame], DataFrame], target: str | None = None) -> DataFrame:
        """Ingest raw records of any source: the payload of those that bring one, the objects that the others refer to.

        `fetch` gives the objects of references (bucket, key, s3_uri, etag), as `fetch_objects` does. A record with
        neither payload nor reference is missing. Payloads are chunked as plain or JSON texts.
        """
        refs = raw.where("payload is null and ref.bucket is not null").select("ref.bucket", "ref.key", "ref.s3_uri", "ref.etag")
        columns = ["doc_id", "source_uri", "doc_content_hash", "extractor", F.col("body").cast("binary").alias("body")]
        fetched = self.chunkers.route(identify(fetch(refs))).select(*columns)
        inline = extras.inline_documents(raw.where("payload is not null or ref.bucket is null")).select(*columns)
        return self.run_documents(fetched.unionByName(inline), target)

    def run_documents(self, docs: DataFrame, target: str | None = None) -> DataFrame:
        """Ingest documents (doc_id, source_uri, doc_content_hash, extractor, body), whatever they come from; see `run`."""
        store = self.store
        ensure_tables(store)
        if target == "active":
            target = get_active(store, self.chunkers.config)["active_collection"]
        target = target or BLUE
        ensure_target(store, target)

        with Kept() as keep:
            found = docs.groupBy("doc_id").agg(
                F.max(F.struct("doc_content_hash", "extractor")).alias("_v"), F.count(F.lit(1)).alias("_rows")
            )
            found = keep(found.select("doc_id", "_v.*", "_rows"))
            versions = found.select("doc_id", "doc_content_hash", "extractor")
            repeated = keep(found.where("_rows > 1").select("doc_id", "doc_content_hash", "extractor"))
            if not at_most(repeated, 0):
                docs = sync.one_row_each(docs, repeated)
            known = versions.where("doc_content_hash is not null")
            # Nothing is indexed in an empty table; what is found is not kept a second time.
            nothing = store.is_empty(target)
            changed = known.select("doc_id", "doc_content_hash") if nothing else keep(sync.changed_versions(known, store.read(target)))
            changed = small_side(changed)
            if at_most(changed, 0):
                applied = changed.select("doc_id", F.lit(0).alias("n"), F.lit(0).alias("dim"))
            else:
                # With nothing left in staging by a run that died, all that is staged is of the changed versions.
                alone = store.is_empty(STAGING)
                self.stage(docs, changed, known.count())
                free_shuffles(store.spark)
                self.embed()
                applied = small_side(keep(self.complete(changed, alone)))
                self.apply(changed, applied, target, alone)
                free_shuffles(store.spark)
            store.overwrite(REPORT, self.report(versions, changed, applied, target))
        store.clean(STAGING)
        return store.read(REPORT)

    def stage(self, docs: DataFrame, changed: DataFrame, versions: int) -> None:
        """Chunk the changed documents that are not staged in this version already; `versions` is the number of documents
        with a version."""
        staged = self.store.read(STAGING).select("doc_id", "doc_content_hash").distinct()
        with Kept() as keep:
            fresh = changed.join(staged, ["doc_id", "doc_content_hash"], "left_anti")
            fresh = changed if self.store.is_empty(STAGING) else small_side(keep(fresh))
            if not at_most(fresh, 0):
                # Bodies are not shuffled to pick all of them, and of many documents not those of others.
                n = fresh.count()
                if n == versions:
                    some = docs.where("doc_id is not null and doc_content_hash is not null")
                else:
                    many = SLIM_ROWS < n <= KEY_ROWS
                    some = sync.changed_documents(likely(docs, fresh, ["doc_id", "doc_content_hash"]) if many else docs, fresh)
                self.store.replace(STAGING, fresh, chunk_documents(some, self.chunkers))

    def embed(self) -> None:
        """Embed what is staged and not embedded with this model, committed in parts by document."""
        model = self.embedder.model
        for part in range(self.commits):
            staged = self.store.read(STAGING).where(F.pmod(F.xxhash64("doc_id"), F.lit(self.commits)) == part)
            todo = sync.needs_embedding(staged, model)
            embedded = (F.col("status") == "embedded") & F.col("model").eqNullSafe(F.lit(model))
            if self.commits == 1 and at_most(staged.where(embedded), 0):
                # Nothing is embedded yet: all rows are written anew, and none has to be left out by later readers.
                if not at_most(todo, 0):
                    self.store.overwrite(STAGING, embed_chunks(todo, self.embedder))
                    # Staging has no readers but this job: the rows without vectors do not stay on the disk.
                    self.store.clean(STAGING)
                continue
            with Kept() as keep:
                waiting = small_side(keep(todo.select("doc_id").distinct()))
                if at_most(waiting, 0):
                    continue
                done = staged.join(waiting, "doc_id", "left_semi").where(embedded)
                self.store.replace(STAGING, waiting, embed_chunks(todo, self.embedder).unionByName(done))

    def complete(self, changed: DataFrame, alone: bool = False) -> DataFrame:
        """The changed documents whose chunks are all embedded: (doc_id, n, dim). `alone`: nothing else is staged."""
        return sync.fully_embedded(self.store.read(STAGING) if alone else self._staged(changed), self.embedder.model)

    def _staged(self, changed: DataFrame) -> DataFrame:
        return self.store.read(STAGING).join(changed, ["doc_id", "doc_content_hash"], "left_semi")

    def apply(self, changed: DataFrame, applied: DataFrame, target: str, alone: bool = False) -> None:
        """Index the complete documents into the target and clear their staging. `alone`: only `changed` is staged."""
        store = self.store
        # Chunks are not shuffled to pick all of them.
        if alone:
            every = at_most(sync.needs_embedding(store.read(STAGING), self.embedder.model), 0)
        else:
            version = ["doc_id", "doc_content_hash"]
            wanted = changed.select(*version).join(applied.select("doc_id"), "doc_id", "left_semi")
            every = at_most(store.read(STAGING).select(*version).distinct().join(wanted, version, "left_anti"), 0)
        chosen = store.read(STAGING) if every else self._staged(changed).join(applied.select("doc_id"), "doc_id", "left_semi")
        rows = sync.knowledge_rows(chosen)
        repeated = checks.duplicate_chunk_ids(rows)
        if not at_most(repeated, 0):
            raise ValueError(f"table {target}: repeated chunk ids, as {repeated.first()}")
        replaced = applied.select("doc_id")
        staged = store.read(STAGING).select("doc_id").distinct()
        if self.prune_empty:
            replaced = replaced.unionByName(changed.select("doc_id").join(staged, "doc_id", "left_anti"))
        wrong = ~F.col("dim").eqNullSafe(F.lit(self.embedder.dim)) | (F.size("embedding") != self.embedder.dim)
        if not at_most(replaced, 0):
            store.replace(target, replaced, rows, {f"vectors not of size {self.embedder.dim}": wrong})
            if every or at_most(staged.join(applied.select("doc_id"), "doc_id", "left_anti"), 0):
                store.overwrite(STAGING, store.read(STAGING).where("false"))
            else:
                store.replace(STAGING, applied.select("doc_id"), None)
            store.maintain(target)

    def report(self, versions: DataFrame, changed: DataFrame, applied: DataFrame, target: str) -> DataFrame:
        is_changed = changed.select("doc_id", F.lit(True).alias("_changed"))
        n = F.coalesce("n", F.lit(0))
        status = (
            F.when(F.col("doc_content_hash").isNull(), "missing")
            .when(F.col("_changed").isNull(), "unchanged")
            .when(n == 0, "empty")
            .otherwise("indexed")
        )
        return (
            versions.join(is_changed, "doc_id", "left")
            .join(applied.select("doc_id", "n"), "doc_id", "left")
            .select(
                "doc_id",
                status.alias("status"),
                n.alias("indexed"),
                F.when(status == "indexed", F.lit(target)).alias("collection"),
                F.when(status == "indexed", F.col("extractor")).alias("extractor"),
            )
        )


def summary(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("indexed").cast("bigint").alias("chunks")
    )


def resync(ingest: Ingest, objects: DataFrame, prefix: str) -> DataFrame:
    """Full re-sync of the objects below a prefix; change detection skips what is indexed already."""
    return ingest.run(objects.where(F.col("key").startswith(prefix)))


def ingest_by_target(ingest: Ingest, objects: DataFrame) -> dict[str, DataFrame]:
    """Ingest into several tables named by the `target` column, one write per target. A target is a table, so there are
    as many names here as there are tables to write; objects without a target go to the default one."""
    names = [r[0] for r in objects.select("target").distinct().collect()]
    return {
        n or BLUE: ingest.run(objects.where(F.col("target").eqNullSafe(F.lit(n))).drop("target"), n)
        for n in sorted(names, key=lambda n: n or "")
    }
