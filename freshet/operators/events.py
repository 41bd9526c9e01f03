"""Object-created notifications: parse, reject, land the latest per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions import text as tx
from freshet.functions.arrays import elements
from freshet.schemas import EVENT_DDL


def _is_object(value: Column) -> Column:
    return F.ltrim(value, F.lit(tx.WHITESPACE)).startswith("{")


def parse(events: DataFrame, value: str = "value") -> DataFrame:
    """Adds `event`, the parsed notification. A notification wrapped in a `Message` text is unwrapped; anything that
    is no JSON object gives NULL."""
    raw = F.when(_is_object(F.col(value)), F.from_json(value, EVENT_DDL))
    wrapped = F.col("_outer.Message")
    inner = F.when(_is_object(wrapped), F.from_json(wrapped, EVENT_DDL))
    unwrap = F.col("_outer.Records").isNull() & wrapped.isNotNull()
    return events.withColumn("_outer", raw).withColumn("event", F.when(unwrap, inner).otherwise(F.col("_outer"))).drop(
        "_outer"
    )


def object_refs(events: DataFrame, value: str = "value") -> DataFrame:
    """One row per created object: the input columns but `value`, then record_no and the fields of a reference.

    Test events, removals, and records without bucket or key give no rows. A map-only stage.
    """
    kept = [c for c in events.columns if c != value]
    return refs_of_records(parse(events, value), kept)


def refs_of_records(parsed: DataFrame, kept: list[str]) -> DataFrame:
    real = F.coalesce(F.col("event.Event"), F.lit("")) != "s3:TestEvent"
    record, thing = F.col("_record"), F.col("_record.s3.object")
    bucket = record["s3"]["bucket"]["name"]
    return (
        parsed.select(*kept, elements(F.when(real, F.col("event.Records"))).alias("record_no", "_record"))
        .where(record["eventName"].contains("ObjectCreated"))
        .select(
            *kept,
            "record_no",
            bucket.alias("bucket"),
            tx.unquote_plus(thing["key"]).alias("key"),
            tx.etag(thing["eTag"]).alias("etag"),
            tx.lenient_size(thing["size"]).alias("size"),
        )
        .where((F.col("bucket") != "") & (F.col("key") != ""))
        .select(
            *kept, "record_no", "bucket", "key", tx.s3_uri(F.col("bucket"), F.col("key")).alias("s3_uri"), "etag",
            "size", F.lit("").alias("content_type"),
        )
    )


# Why an event cannot be landed.
NO_JSON, NO_OBJECT, TEST_EVENT, NO_KEY = "not JSON", "no object", "test event", "no key"
# Repeated member names are allowed and the last one counts; quotes must be double.
_STRICT = {"allowSingleQuotes": "false"}


def classified(events: DataFrame, value: str = "value") -> DataFrame:
    """Adds `landing_key` and `reason`: every event has one of the two. A map-only stage that parses once.

    The key is the event's own Key, else bucket/key of its first record; a notification wrapped in a `Message` text is
    unwrapped first. Without a key the reason says why: no JSON, no object, a test event, an object that names nothing.
    """
    # As the only element of an array: what follows an object is an error then, and a field of another type is not.
    whole = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), f"array<struct<{_struct_of(EVENT_DDL)}>>", _STRICT)
    wrapped = F.col("_event.Message")
    inner = F.when(_is_object(wrapped), F.from_json(wrapped, EVENT_DDL, _STRICT))
    unwrap = F.col("_event.Records").isNull() & wrapped.isNotNull()
    first = F.get(F.col("_event.Records"), F.lit(0))["s3"]
    key = F.coalesce(F.col("_event.Key"), F.concat(first["bucket"]["name"], F.lit("/"), first["object"]["key"]))
    other = F.when(F.try_parse_json(value).isNull(), NO_JSON).otherwise(NO_OBJECT)
    reason = (
        F.when(F.col("_read") != 1, other).when(F.col("_event.Event") == "s3:TestEvent", TEST_EVENT).otherwise(NO_KEY)
    )
    # Lists of one element keep the optimizer from parsing once per use.
    return (
        events.select(*events.columns, elements(F.array(whole)).alias("_no", "_whole"))
        .withColumn("_event", F.get("_whole", F.lit(0)))
        .withColumn("_read", F.when(F.col("_event").isNull(), 0).otherwise(F.size("_whole")))
        .withColumn("_event", F.when(unwrap, inner).otherwise(F.col("_event")))
        .withColumn("landing_key", F.when(F.col("_read") == 1, key))
        .withColumn("reason", F.when(F.col("landing_key").isNull(), reason))
        .select(*events.columns, "landing_key", "reason")
    )


def _struct_of(ddl: str) -> str:
    """Fields of a table schema as those of a struct type."""
    return T.StructType.fromDDL(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def rejects(events: DataFrame, value: str = "value") -> DataFrame:
    """Events that cannot be landed, with the reason."""
    return classified(events, value).where(F.col("reason").isNotNull()).drop("landing_key")


def landing_key(events: DataFrame, value: str = "value") -> DataFrame:
    """Events that can be landed, with their `landing_key`."""
    return classified(events, value).where(F.col("reason").isNull()).drop("reason")


# Events in the order in which they came into being: by time, and for one time by partition and place in it.
ORDER = ["at", "partition", "offset"]


def placed(events: DataFrame) -> DataFrame:
    """`events` with `at` (microseconds, from `timestamp` where there is one) and `partition`, to be put in order by."""
    has = events.columns
    at = F.unix_micros("timestamp") if "timestamp" in has else F.lit(None).cast("bigint")
    partition = F.col("partition") if "partition" in has else F.lit(0)
    return events.withColumns({"at": F.coalesce(at, F.lit(0).cast("bigint")), "partition": partition.cast("int")})


def heads(landable: DataFrame) -> DataFrame:
    """Which event is the last of each key: (landing_key, at, partition, offset, events). Texts take no part; a key with
    a third of all events sends one row per task."""
    order = F.struct(*ORDER)
    return landable.groupBy("landing_key").agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("events")).select(
        "landing_key", "_last.*", "events"
    )


def latest_per_key(landed: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row per key. `max_by` is combined map-side, so a key with a third of all events sends one row per
    task instead of all its events."""
    rest = [c for c in landed.columns if c != key]
    return (
        landed.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(key, *[F.col("_last")[c].alias(c) for c in rest])
    )


def changes(feed: DataFrame, op: str = "op") -> DataFrame:
    """Inserts, replacements and updates of a change feed; deletes are not followed."""
    return feed.where(F.col(op).isin("insert", "replace", "update"))


def first_record_triggers(feed: DataFrame, value: str = "value") -> DataFrame:
    """The short trigger form: bucket and key of the first record as they are, neither decoded nor filtered."""
    first = F.get(F.col("_e.Records"), F.lit(0))["s3"]
    kept = [c for c in feed.columns if c != value]
    return feed.withColumn("_e", F.from_json(value, EVENT_DDL)).select(
        *kept, first["bucket"]["name"].alias("bucket"), first["object"]["key"].alias("key")
    )
