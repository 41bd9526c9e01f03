"""Rows of a database into the index: inserted and revised rows are indexed, deleted ones leave it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.config import BLUE
from freshet.functions.sizes import Kept, at_most, small_side
from freshet.operators import extras
from freshet.plans.ingest import Ingest, ensure_tables, ensure_target
from freshet.sources.pointer import get_active
from freshet.sources.snapshots import Snapshots


def sync_rows(
    ingest: Ingest, snapshots: Snapshots, rows: DataFrame, table: str, key: str, columns: list[str], target: str | None = None
) -> DataFrame:
    """Bring the index in line with `rows`, the present rows of a database table.

    A row is the document `<table>://<key>`, its version the hash of its compact JSON. Returns a report: doc_id, change
    (insert, update, delete), indexed (chunks in the target afterwards). Rows that did not change are hashed and no more.
    `target` is the table to write, "active" the one searched at the moment. Rows without a key are no documents and are
    left out. Of several rows with one key the one with the largest hash is taken.
    An empty table deletes what it had. A sync that died is run again; only one at a time may use `snapshots`.
    """
    store = ingest.store
    ensure_tables(store)
    if target == "active":
        target = get_active(store, ingest.chunkers.config)["active_collection"]
    target = target or BLUE
    ensure_target(store, target)
    docs = extras.row_documents(rows.where(F.col(key).isNotNull()), table, key, columns)
    new = snapshots.write(docs.select("doc_id", F.col("doc_content_hash").alias("row_hash")))
    last = snapshots.last()
    with Kept() as keep:
        changes = snapshots.changes(last, new)
        # Without an earlier snapshot the changes are the new one as it lies there.
        changes = small_side(keep(changes) if last else changes)
        wanted = changes.where("change <> 'delete'").select("doc_id", F.col("row_hash").alias("doc_content_hash"))
        if not at_most(wanted, 0):
            # Without an earlier snapshot every row is wanted; an ingest takes the one with the largest hash itself.
            ingest.run_documents(docs.join(wanted, ["doc_id", "doc_content_hash"], "left_semi") if last else docs, target)
        gone = changes.where("change = 'delete'").select("doc_id")
        if not at_most(gone, 0):
            store.replace(target, gone, None)
            store.maintain(target)
        held = store.read(target).select("doc_id").join(changes.select("doc_id"), "doc_id", "left_semi")
        counts = held.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("indexed"))
        report = changes.join(counts, "doc_id", "left").select("doc_id", "change", F.coalesce("indexed", F.lit(0)).alias("indexed"))
        store.ensure(f"{table}_sync", "doc_id STRING, change STRING, indexed INT")
        store.overwrite(f"{table}_sync", report)
    snapshots.commit(new)
    return store.read(f"{table}_sync")
