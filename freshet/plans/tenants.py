"""One ingest for all tenants: objects name the target that they belong to, and one read and one write serve all of them.

Targets are values of a partition column of one table, so a new tenant needs no set-up and a search of one tenant reads
its folders only. A version of a document that several tenants hold is chunked and embedded once, however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas
from freshet.config import BLUE
from freshet.functions.sizes import SLIM_ROWS, Kept, at_most, small_side
from freshet.operators import sync
from freshet.operators.chunking import Chunkers, chunk_documents
from freshet.operators.embedding import Embedder, HashedBagOfWords, embed_chunks
from freshet.operators.routing import identify
from freshet.sources.tables import TableStore

TENANTS, TENANT_STAGING, TENANT_REPORT = "tenant_chunks", "tenant_staging", "tenant_report"

_VERSION = ["doc_id", "doc_content_hash"]
_KEYS = ["target", "doc_id"]
# Rows of names alone (about 80 bytes each) that may be broadcast: as many bytes as of other slim tables.
NAME_ROWS = 500_000


@dataclass
class TenantIngest:
    """Vectors of another size than the embedder's stop an ingest before its rows are seen by anyone."""

    store: TableStore
    embedder: Embedder = field(default_factory=HashedBagOfWords)
    chunkers: Chunkers = field(default_factory=Chunkers)
    default: str = BLUE

    def ensure(self) -> None:
        order = ("target", "doc_id", "ordinal")
        self.store.ensure(TENANTS, f"target STRING, {schemas.KNOWLEDGE}", "target,doc_id", order, ("target",))
        # Staged rows are read as a whole, so they are not sorted. Their target is the one whose copy was chunked.
        self.store.ensure(TENANT_STAGING, f"{schemas.STAGING}, target STRING", ",".join(_VERSION))
        self.store.ensure(TENANT_REPORT, f"target STRING, {schemas.INGEST_REPORT}")

    def chunks(self, target: str) -> DataFrame:
        """What one tenant searches; other tenants' folders are not read."""
        return self.store.read(TENANTS).where(F.col("target") == target).drop("target")

    def run(self, objects: DataFrame) -> DataFrame:
        """Ingest objects (target, bucket, key, content_type, body; pages for paged types).

        Returns the report, also kept as a table: target, doc_id, status (unchanged, empty, missing, indexed), indexed,
        collection, extractor. Objects without a target go to the default one. A version is known if it is what that
        target holds now, so one that comes back after another is indexed again. Of several rows for one object and
        target the one with the largest version hash is taken. A new version without chunks leaves the old chunks.
        A run that died is run again: what it had embedded is not embedded again.
        """
        self.ensure()
        # An empty name cannot be a folder of its own.
        target = F.coalesce(F.nullif(F.col("target"), F.lit("")), F.lit(self.default))
        docs = self.chunkers.route(identify(objects)).withColumn("target", target)
        with Kept() as keep:
            versions = keep(
                docs.groupBy("target", "doc_id")
                .agg(F.max(F.struct("doc_content_hash", "extractor")).alias("_v"), F.count(F.lit(1)).alias("_rows"))
                .select("target", "doc_id", "_v.*", "_rows")
            )
            held = self.store.read(TENANTS).select("target", *_VERSION).distinct()
            known = versions.where("doc_content_hash is not null")
            changed = small_side(keep(known.join(held, ["target", *_VERSION], "left_anti")))
            if at_most(changed, 0):
                counts = changed.select("target", "doc_id", F.lit(0).alias("n"))
            else:
                self.stage(docs, versions, changed)
                counts = keep(self.apply(changed))
            self.store.overwrite(TENANT_REPORT, self.report(versions, changed, counts))
        return self.store.read(TENANT_REPORT)

    def stage(self, docs: DataFrame, versions: DataFrame, changed: DataFrame) -> None:
        """Chunk and embed each changed version that is not staged yet, once for all targets."""
        staged = self.store.read(TENANT_STAGING).where(F.col("model") == self.embedder.model).select(*_VERSION).distinct()
        with Kept() as keep:
            # One target's copy of a version stands for all: bodies are chosen by their slim columns, not shuffled.
            one = changed.groupBy(*_VERSION).agg(F.min(F.struct("extractor", "target", "_rows")).alias("_one"))
            fresh = keep(one.join(staged, _VERSION, "left_anti").select(*_VERSION, "_one.*"))
            if at_most(fresh, 0):
                return
            chosen = self.only_rows(docs, versions, keep(fresh.where("_rows = 1").select(*_KEYS)))
            repeated = small_side(fresh.where("_rows > 1").drop("_rows"))
            if not at_most(repeated, 0):
                again = docs.join(repeated, repeated.columns, "left_semi").dropDuplicates(repeated.columns)
                chosen = chosen.unionByName(again)
            rows = embed_chunks(chunk_documents(chosen, self.chunkers, ["target"]), self.embedder)
            self.store.replace(TENANT_STAGING, small_side(fresh.select(*_VERSION)), rows)

    def only_rows(self, docs: DataFrame, versions: DataFrame, wanted: DataFrame) -> DataFrame:
        """The rows of the `wanted` names, which have one row each: found by name, so that no other body is hashed.

        Bodies are not shuffled as long as the names that are wanted, or those that are not, are few.
        """
        if at_most(wanted, NAME_ROWS):
            return docs.join(F.broadcast(wanted), _KEYS, "left_semi")
        with Kept() as keep:
            others = keep(versions.select(*_KEYS).where("doc_id is not null").join(wanted, _KEYS, "left_anti"))
            few, none = at_most(others, NAME_ROWS), at_most(others, 0)
        if not few:
            return docs.join(wanted, _KEYS, "left_semi")
        named = docs.where("doc_id is not null")
        return named if none else named.join(F.broadcast(others), _KEYS, "left_anti")

    def apply(self, changed: DataFrame) -> DataFrame:
        """Write the staged chunks of all targets at once; returns how many each (target, doc_id) got."""
        store = self.store
        staged = store.read(TENANT_STAGING)
        wrong = ~F.col("dim").eqNullSafe(F.lit(self.embedder.dim)) | (F.size("embedding") != self.embedder.dim)
        with Kept() as keep:
            sizes = staged.groupBy(*_VERSION).agg(F.count(F.lit(1)).cast("int").alias("n"))
            counts = keep(changed.join(sizes, _VERSION).select("target", "doc_id", "n"))
            total = counts.count()
            if total:
                rows = self.dealt(staged, changed, keep).select("target", *sync.KNOWLEDGE_COLUMNS)
                store.replace(TENANTS, small_side(counts), rows, {f"vectors not of size {self.embedder.dim}": wrong})
        # The counts of the report are those of what the targets hold now.
        after = store.read(TENANTS).groupBy("target", *_VERSION).agg(F.count(F.lit(1)).cast("int").alias("n"))
        store.overwrite(TENANT_STAGING, staged.where("false"))
        store.maintain(TENANTS)
        return after.join(changed, ["target", *_VERSION], "left_semi").select(*_KEYS, "n")

    def dealt(self, staged: DataFrame, changed: DataFrame, keep: Kept) -> DataFrame:
        """Staged rows once for each target that changed to their version.

        Of very many versions only those that further targets hold are looked up; the others' rows name their target.
        """
        plain = staged.drop("target", "extractor").join(changed, _VERSION)
        # A table of an earlier make has no targets.
        if "target" not in staged.columns or at_most(changed, SLIM_ROWS):
            return plain
        homes = keep(staged.select(*_VERSION, "target").distinct())
        own = ["target", *_VERSION]
        more = keep(changed.join(homes.select(*_VERSION), _VERSION, "left_semi").join(homes, own, "left_anti").select(*own))
        # What a run that died had staged may be for a target that holds it by now.
        if not at_most(homes.join(changed, own, "left_anti"), 0) or not at_most(more, SLIM_ROWS):
            return plain
        also = more.groupBy(*_VERSION).agg(F.collect_list("target").alias("_also"))
        targets = F.concat(F.array("target"), F.coalesce("_also", F.array().cast("array<string>")))
        return staged.join(F.broadcast(also), _VERSION, "left").withColumn("target", F.explode(targets))

    def report(self, versions: DataFrame, changed: DataFrame, counts: DataFrame) -> DataFrame:
        keys = ["target", "doc_id"]
        n = F.coalesce("n", F.lit(0))
        status = (
            F.when(F.col("doc_content_hash").isNull(), "missing")
            .when(F.col("_changed").isNull(), "unchanged")
            .when(n == 0, "empty")
            .otherwise("indexed")
        )
        indexed = status == "indexed"
        return (
            versions.join(changed.select(*keys, F.lit(True).alias("_changed")), keys, "left")
            .join(counts.select(*keys, "n"), keys, "left")
            .select(
                *keys, status.alias("status"), n.alias("indexed"),
                F.when(indexed, F.col("target")).alias("collection"), F.when(indexed, F.col("extractor")).alias("extractor"),
            )
        )
