"""Event streams: sources, landing, and the feed of what landed.

Landing is append-only. A batch of events is parsed once and written once, as plain Parquet, into one folder for what can
be landed and one for what cannot, each by batch number; repeating a batch replaces its own folders and nothing else.
Beside them lie slim tables: the last event of each key in the batch, and an account of where all its events went. The
feed of changes is a stream over the slim table: keyed state knows which event of a key is the last one seen, and so
tells an insert from a replacement and drops what came too late. Texts are fetched for the changes alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.sizes import Kept, small_side
from freshet.operators import events as ev

EVENTS = "landing_key STRING, reason STRING, at BIGINT, partition INT, offset BIGINT, value STRING, outcome STRING, batch BIGINT"
HEADS = "landing_key STRING, at BIGINT, partition INT, offset BIGINT, events BIGINT, batch BIGINT"
ACCOUNT = "batch BIGINT, input BIGINT, landed BIGINT, superseded BIGINT, rejected BIGINT, reasons MAP<STRING,BIGINT>"
LANDABLE, REJECTED = "landable", "rejected"


def kafka_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The event topic as (key, partition, offset, timestamp, value). Needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    key, value = (F.col(c).cast("string").alias(c) for c in ("key", "value"))
    return stream.load().select(key, "partition", "offset", "timestamp", value)


def file_events(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, schema: str = "offset BIGINT, value STRING"
) -> DataFrame:
    """Files of JSON lines {"offset": ..., "value": ...} as an event stream; `schema` may name partition and timestamp."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return stream.json(folder)


def for_each_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run `work` batch by batch; a restart goes on from the checkpoint. `trigger` is that of a stream writer, by
    default all that is available and then an end; {"processingTime": "10 seconds"} goes on until it is stopped."""
    return (
        stream.writeStream.foreachBatch(work)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# ---- landing --------------------------------------------------------------------------------------------------------

def land(events: DataFrame, root: str, batch: int) -> dict:
    """Land one batch of events (offset, value, perhaps partition and timestamp) below `root`; returns its account.

    Every event is in one place: landed as the last of its key in the batch, superseded by a later one, or rejected.
    An event is known by its partition and offset.
    """
    spark = events.sparkSession
    counted = Observation(f"land-{batch}")
    reasons = [ev.NO_JSON, ev.NO_OBJECT, ev.TEST_EVENT, ev.NO_KEY]
    parsed = ev.classified(ev.placed(events)).select(
        "landing_key", "reason", *ev.ORDER, "value",
        F.when(F.col("reason").isNull(), LANDABLE).otherwise(REJECTED).alias("outcome"), F.lit(batch).cast("bigint").alias("batch"),
    )
    parsed = parsed.observe(
        counted, F.count(F.lit(1)).alias("input"),
        *[F.count(F.when(F.col("reason") == r, 1)).alias(f"r{i}") for i, r in enumerate(reasons)],
    )
    _replace(parsed, f"{root}/events", ["outcome", "batch"])
    slim = _events(spark, root).where((F.col("outcome") == LANDABLE) & (F.col("batch") == batch)).select("landing_key", *ev.ORDER)
    landed = Observation(f"heads-{batch}")
    last = ev.heads(slim).withColumn("batch", F.lit(batch).cast("bigint")).observe(
        landed, F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("events"), F.lit(0)).alias("events")
    )
    _replace(last, f"{root}/heads", ["batch"])
    seen, kept = counted.get, landed.get
    by_reason = {r: seen[f"r{i}"] for i, r in enumerate(reasons) if seen[f"r{i}"]}
    row = {
        "batch": batch, "input": seen["input"], "landed": kept["keys"], "superseded": kept["events"] - kept["keys"],
        "rejected": sum(by_reason.values()), "reasons": by_reason,
    }
    _replace(spark.createDataFrame([row], ACCOUNT), f"{root}/account", ["batch"])
    return row


def _replace(rows: DataFrame, path: str, by: list[str]) -> None:
    """Write the folders that `rows` has and leave all others as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def land_stream(stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return for_each_batch(stream, lambda batch, number: land(batch, root, number), checkpoint, trigger)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written by batches; without any batch it is empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _events(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/events", EVENTS)


def account(spark: SparkSession, root: str) -> DataFrame:
    """Where the events of each batch went."""
    return _read(spark, f"{root}/account", ACCOUNT)


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """Events that were not landed, with the reason."""
    return _events(spark, root).where(F.col("outcome") == REJECTED).drop("landing_key", "outcome")


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The last event of each key over all batches: (landing_key, offset, value). Which ones these are is decided on the
    slim table; texts are looked up by batch, partition and offset."""
    order = F.struct(*ev.ORDER, "batch")
    last = _read(spark, f"{root}/heads", HEADS).groupBy("landing_key").agg(F.max(order).alias("_last"))
    return with_values(spark, root, last.select("landing_key", "_last.*")).select("landing_key", "offset", "value")


def with_values(spark: SparkSession, root: str, some: DataFrame) -> DataFrame:
    """Slim rows of landed events (landing_key, batch, partition, offset, ...) with their texts."""
    texts = _events(spark, root).where(F.col("outcome") == LANDABLE)
    places = ["landing_key", "batch", "partition", "offset"]
    return texts.select(*places, "value").join(some, places)


# ---- the feed of changes --------------------------------------------------------------------------------------------

def changes(landed: DataFrame) -> DataFrame:
    """The feed of a stream over the slim table: one row per key that got a later event, `insert` or `replace`.

    State is a few numbers per key, kept and compared by Spark itself. A key has one row per landed batch, however many
    events it had there. Batches of the feed are told apart by the time that Spark notes for each, which a batch that is
    repeated has again. Of events in one place the one seen first counts. The stream is one of updates.
    """
    now = F.unix_micros(F.current_timestamp())
    last = F.max(F.struct(*ev.ORDER, (-F.col("_seen")).alias("_seen"), "batch"))
    known = landed.withColumn("_seen", now).groupBy("landing_key").agg(
        F.min("_seen").alias("_first"), F.max("_seen").alias("_latest"), last.alias("_last")
    )
    # Should the clock have been put back, a key seen before is still no new one.
    op = F.when((F.col("_first") == now) & (F.col("_latest") == now), "insert").otherwise("replace")
    # A column of its own: a batch that is known to be sorted by the key of the state cannot be persisted (Spark 4.1).
    key = F.concat("landing_key", F.lit("")).alias("landing_key")
    return known.where(F.col("_last._seen") == -now).select(key, *[f"_last.{c}" for c in (*ev.ORDER, "batch")], op.alias("op"))


def landed_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(HEADS).option("maxFilesPerTrigger", files_per_batch).parquet(f"{root}/heads")


def follow(
    spark: SparkSession, root: str, work: Callable[[DataFrame], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Give `work` the changes since the checkpoint, with their texts: (landing_key, batch, partition, offset, value, at,
    op). Needs one landed batch at least."""

    def batch(feed: DataFrame, _: int) -> None:
        with Kept() as keep:
            work(with_values(spark, root, small_side(keep(feed))))

    return for_each_batch(changes(landed_stream(spark, root)), batch, checkpoint, trigger, "update")
