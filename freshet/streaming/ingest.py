"""From a feed of events to searchable chunks, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.functions import text as tx
from freshet.functions.sizes import Kept
from freshet.operators import events as ev
from freshet.operators.sync import latest_per_document
from freshet.plans.ingest import Ingest
from freshet.sources.files import named_objects
from freshet.streaming.landing import follow, for_each_batch

# A table of objects with their bodies, or a function that fetches the bodies of references.
Objects = DataFrame | Callable[[DataFrame], DataFrame]


def triggered_refs(feed: DataFrame) -> DataFrame:
    """References of a batch of changes, the newest trigger of each document only."""
    changes = ev.changes(feed) if "op" in feed.columns else feed
    refs = ev.object_refs(changes).withColumn("doc_id", tx.document_id(F.col("s3_uri")))
    return latest_per_document(refs, [*(c for c in ev.ORDER if c in refs.columns), "record_no"])


def ingest_batch(
    feed: DataFrame, objects: Objects, ingest: Ingest, target: str | None = None,
    on_report: Callable[[DataFrame], None] | None = None,
) -> None:
    """Ingest the documents that a batch of the feed names. `feed` has offset and value, perhaps op."""
    with Kept() as keep:
        refs = keep(triggered_refs(feed))
        docs = objects(refs) if callable(objects) else named_objects(refs, objects)
        report = ingest.run(docs, target)
        if on_report:
            on_report(report)


def ingest_stream(
    stream: DataFrame, objects: Objects, ingest: Ingest, checkpoint: str, target: str | None = None,
    on_report: Callable[[DataFrame], None] | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Changes since the checkpoint, also those that came while nothing was running."""
    return for_each_batch(
        stream, lambda batch, _: ingest_batch(batch, objects, ingest, target, on_report), checkpoint, trigger
    )


def ingest_landed(
    spark: SparkSession, root: str, objects: Objects, ingest: Ingest, checkpoint: str, target: str | None = None,
    on_report: Callable[[DataFrame], None] | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest what the landed events below `root` name: the change feed, not the raw events, starts an ingest."""
    return follow(
        spark, root, lambda feed: ingest_batch(feed, objects, ingest, target, on_report), checkpoint, trigger
    )
