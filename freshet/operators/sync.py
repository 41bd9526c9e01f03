"""Change detection, staging and upserts, as joins between tables.

Texts and vectors are wide; ids and hashes are slim. Decisions are made on slim tables, and wide rows are touched only
once it is known which of them matter. Nothing here runs a job: a caller that has a slim table at hand marks it with
`small_side`, so that the wide side of the join is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWLEDGE_COLUMNS = [
    "doc_id", "chunk_id", "ordinal", "text", "content_hash", "doc_content_hash", "embedding", "model", "dim",
    "source_uri", "metadata",
]


def indexed_versions(knowledge: DataFrame) -> DataFrame:
    """(doc_id, doc_content_hash) pairs that are indexed. Combined map-side to about one row per document."""
    return knowledge.select("doc_id", "doc_content_hash").distinct()


def latest_per_document(refs: DataFrame, order: list[str]) -> DataFrame:
    """The newest trigger of each document wins."""
    rest = [c for c in refs.columns if c != "doc_id"]
    return (
        refs.groupBy("doc_id")
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select("doc_id", *[F.col("_last")[c].alias(c) for c in rest])
    )


def changed_versions(docs: DataFrame, knowledge: DataFrame) -> DataFrame:
    """(doc_id, doc_content_hash) of documents whose version is not indexed. Only ids and hashes are shuffled."""
    return docs.select("doc_id", "doc_content_hash").join(
        indexed_versions(knowledge), ["doc_id", "doc_content_hash"], "left_anti"
    )


def changed_documents(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The documents of `changed`, whole. Bodies stay where they are unless very many documents changed."""
    return docs.join(changed, ["doc_id", "doc_content_hash"], "left_semi")


def one_row_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """`docs` with one row for each document of `repeated` (doc_id and the columns of its version), one of that version.
    Only rows of repeated documents are shuffled."""
    single = docs.join(repeated.select("doc_id"), "doc_id", "left_anti")
    chosen = docs.join(repeated, repeated.columns, "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(chosen)


def ingest_plan(docs: DataFrame, knowledge: DataFrame, chunk_count: Column) -> DataFrame:
    """What an ingest will do per document: unchanged, empty or staged, and the number of chunks to stage.

    `chunk_count` is an expression over `docs`. It is computed for changed documents only.
    """
    versions = indexed_versions(knowledge).withColumn("_known", F.lit(True))
    joined = docs.join(versions, ["doc_id", "doc_content_hash"], "left")
    n = F.when(F.col("_known").isNull(), chunk_count).otherwise(0)
    return joined.select("doc_id", "doc_content_hash", "_known", n.alias("n")).select(
        "doc_id",
        "doc_content_hash",
        F.when(F.col("_known"), "unchanged").when(F.col("n") == 0, "empty").otherwise("staged").alias("status"),
        "n",
    )


def replace_staging(staging: DataFrame, staged_docs: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Staging with all rows of `staged_docs` (doc_id) replaced; documents that yield no chunk leave nothing."""
    return staging.join(staged_docs.select("doc_id"), "doc_id", "left_anti").unionByName(new_rows)


def needs_embedding(staged: DataFrame, model: str) -> DataFrame:
    """Staged chunks not yet embedded with this model."""
    done = (F.col("status") == "embedded") & F.col("model").eqNullSafe(F.lit(model))
    return staged.where(~done)


def missing_chunks(requested: DataFrame, staged: DataFrame) -> DataFrame:
    """Requested chunk ids that are not staged; must be empty."""
    return requested.select("chunk_id").join(staged.select("chunk_id"), "chunk_id", "left_anti")


def mark_embedded(staged: DataFrame, vectors: DataFrame) -> DataFrame:
    """Staged chunks with the vectors of (chunk_id, embedding, model, dim) filled in."""
    new = vectors.select("chunk_id", *[F.col(c).alias(f"_{c}") for c in ("embedding", "model", "dim")])
    joined = staged.join(new, "chunk_id", "left")
    got = F.col("_embedding").isNotNull()
    filled = {c: F.when(got, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("embedding", "model", "dim")}
    return joined.withColumns(
        {**filled, "status": F.when(got, "embedded").otherwise(F.col("status"))}
    ).select(*staged.columns)


def fully_embedded(staged: DataFrame, model: str) -> DataFrame:
    """Documents all of whose chunks are embedded with `model`: (doc_id, n, dim), dim being that of the first chunk."""
    done = F.when((F.col("status") == "embedded") & (F.col("model") == model), 1).otherwise(0)
    return (
        staged.groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).cast("int").alias("n"),
            F.sum(done).alias("_done"),
            F.min_by("dim", "ordinal").alias("dim"),
        )
        .where(F.col("_done") == F.col("n"))
        .drop("_done")
    )


def knowledge_rows(embedded: DataFrame) -> DataFrame:
    return embedded.select(*KNOWLEDGE_COLUMNS)


def prune_stale(table: DataFrame, counts: DataFrame) -> DataFrame:
    """Drops rows whose ordinal is at or beyond the document's new chunk count (doc_id, n)."""
    return (
        table.join(counts.select("doc_id", F.col("n").alias("_n")), "doc_id", "left")
        .where(F.col("_n").isNull() | (F.col("ordinal") < F.col("_n")))
        .drop("_n")
    )


def upsert(table: DataFrame, rows: DataFrame, key: str = "chunk_id") -> DataFrame:
    """`rows` replace the rows of `table` with the same key and add the others."""
    return table.join(rows.select(key), key, "left_anti").unionByName(rows)


def apply_documents(knowledge: DataFrame, applied: DataFrame, rows: DataFrame) -> DataFrame:
    """The table after indexing whole documents: upsert by chunk and prune of the stale tail in one step.

    All chunks of each document in `applied` (doc_id) are in `rows`, ordinals 0 to n-1, so the upsert overwrites every
    old chunk below n and the prune removes the rest: together that is a replacement of the document. Old wide rows
    then need only a membership test on doc_id; they are not shuffled while `applied` is small.
    """
    kept = knowledge.join(applied.select("doc_id"), "doc_id", "left_anti")
    return kept.unionByName(rows)


def clear_staging(staging: DataFrame, indexed: DataFrame) -> DataFrame:
    return staging.join(indexed.select("doc_id"), "doc_id", "left_anti")


def page_after(table: DataFrame, cursor: str | None, n: int, key: str = "chunk_id") -> DataFrame:
    """The next `n` rows in key order after `cursor`."""
    rest = table if cursor is None else table.where(F.col(key) > cursor)
    return rest.orderBy(key).limit(n)
