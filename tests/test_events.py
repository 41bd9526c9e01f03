import json

from pyspark.sql import functions as F

from freshet.functions import text as tx
from freshet.operators import events as ev


def record(name="s3:ObjectCreated:Put", bucket="b", key="k.md", **more):
    return {"eventName": name, "s3": {"bucket": {"name": bucket}, "object": {"key": key, **more}}}


def frame(spark, values):
    rows = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "offset BIGINT, value STRING")


def test_references(spark):
    events = [
        {"Records": [record(key="docs%2Fmy+doc.md", size="17", eTag='"e1"'), record(key="a%zzb", size=None)]},
        {"Records": [record("ObjectCreated:Copy", key="100%"), record("s3:ObjectRemoved:Delete"), record(bucket="")]},
        {"Message": json.dumps({"Records": [record(key="wrapped")]})},
        {"Event": "s3:TestEvent"},
        {"Message": "[1]"},
        [1],
        "not json",
        {"Records": []},
        {"Records": [record(key="late", size="x")], "Event": "s3:TestEvent"},
    ]
    got = ev.object_refs(frame(spark, events)).orderBy("offset", "record_no").collect()
    assert [(r["offset"], r["key"], r["etag"], r["size"]) for r in got] == [
        (0, "docs/my doc.md", "e1", 17), (0, "a%zzb", "", 0), (1, "100%", "", 0), (2, "wrapped", "", 0),
    ]
    assert got[0]["s3_uri"] == "s3://b/docs/my doc.md"


def test_rejects_and_landing(spark):
    events = ["not json", "[1]", {"Key": "b/k", "Records": [record()]}, {"Records": [record(key="plain")]}, "{bad", {"x": 1},
              {"Key": "b/k", "Records": [record(key="newer")]}]
    df = frame(spark, events)
    assert sorted(r["offset"] for r in ev.rejects(df).collect()) == [0, 1, 4, 5]
    last = ev.latest_per_key(ev.landing_key(df), "landing_key", ["offset"]).orderBy("landing_key").collect()
    assert [(r["landing_key"], r["offset"]) for r in last] == [("b/k", 6), ("b/plain", 3)]


def test_every_event_lands_or_has_a_reason(spark):
    wrapped = json.dumps({"Message": json.dumps({"Key": "in"})})
    want = {
        "not json": ev.NO_JSON, "{bad": ev.NO_JSON, "": ev.NO_JSON, '{"Key":"a",}': ev.NO_JSON, "{'Key':'a'}": ev.NO_JSON,
        "[1]": ev.NO_OBJECT, "null": ev.NO_OBJECT, "5": ev.NO_OBJECT, '[{"Key":"a"}]': ev.NO_OBJECT,
        '{"x":1}': ev.NO_KEY, '{"Records":[]}': ev.NO_KEY, '{"Key":null}': ev.NO_KEY, '{"Event":"s3:TestEvent"}': ev.TEST_EVENT,
        '{"Key":"b/k","Key":"b/k"}': None, '{"Key":"k","Records":5}': None, '  {"Key":"k"} ': None, wrapped: None,
        '{"Key":"k","Event":"s3:TestEvent"}': None, json.dumps({"Records": [record()]}): None,
    }
    got = {r["value"]: (r["landing_key"], r["reason"]) for r in ev.classified(frame(spark, list(want))).collect()}
    assert {v: reason for v, (_, reason) in got.items()} == want
    assert all((key is None) == (reason is not None) for key, reason in got.values())
    assert got[wrapped][0] == "in" and got['{"Key":"b/k","Key":"b/k"}'][0] == "b/k"
    (null,) = ev.classified(spark.createDataFrame([(1, None)], "offset BIGINT, value STRING")).collect()
    assert (null["landing_key"], null["reason"]) == (None, ev.NO_JSON)


def test_one_parse_and_no_text_in_a_shuffle(spark):
    df = frame(spark, [{"Key": "b/k"}, {"Key": "b/k"}, "x"])
    plan = ev.classified(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 2 + plan.count("Filter") and "Exchange" not in plan
    slim = ev.heads(ev.landing_key(ev.placed(df)))._jdf.queryExecution().optimizedPlan().toString()
    assert "max(struct(at" in slim and slim.split("Project")[0].count("value") == 0


def test_order_over_partitions(spark):
    """The last event of a key is that of the latest time, wherever it lies and whatever its offset."""
    rows = [("2024-01-01 00:00:05", 0, 9, "a"), ("2024-01-01 00:00:07", 1, 2, "a"), ("2024-01-01 00:00:06", 2, 50, "a"),
            ("2024-01-01 00:00:01", 0, 3, "b"), ("2024-01-01 00:00:01", 1, 1, "b"), (None, 2, 99, "b")]
    df = spark.createDataFrame(rows, "timestamp STRING, partition INT, offset BIGINT, landing_key STRING").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    got = {r["landing_key"]: (r["partition"], r["offset"], r["events"]) for r in ev.heads(ev.placed(df)).collect()}
    assert got == {"a": (1, 2, 3), "b": (1, 1, 3)}


def test_changes_and_short_triggers(spark):
    feed = frame(spark, [{"Records": [record(key="a%2Fb"), record(key="second")]}, {"Records": [record()]}]).withColumn(
        "op", F.when(F.col("offset") == 1, "delete").otherwise("insert")
    )
    assert [tuple(r) for r in ev.first_record_triggers(ev.changes(feed)).collect()] == [(0, "insert", "b", "a%2Fb")]


def test_scalar_functions(spark):
    row = spark.range(1).select(
        tx.decode_utf8(F.lit(b"\xff\xfe")).alias("two"),
        tx.decode_utf8(F.lit(b"\xe2\x82x")).alias("one"),
        tx.decode_utf8(F.lit(b"\xed\xa0\x80")).alias("three"),
        tx.first_http_url(F.lit("read (https://a.b/c?d=1). ok")).alias("url"),
        tx.first_http_url(F.lit("none")).alias("no_url"),
        tx.citation_numbers(F.lit("see [2] and [1] [2] [0] [12]")).alias("cited"),
        tx.basename(F.lit("s3://b/x/y.md")).alias("base"),
        tx.basename(F.lit("s3://b/x/")).alias("no_base"),
        tx.round4(F.lit(0.03125)).alias("tie"),
        tx.round4(F.lit(0.12344)).alias("plain"),
        tx.etag(F.lit('"abc"')).alias("etag"),
        tx.extension(F.lit("a/B.Tar.GZ")).alias("ext"),
        tx.guess_mime(F.lit("x.unknown"), "application/octet-stream").alias("mime"),
    ).first()
    assert (row["two"], row["one"], row["three"]) == ("�" * 2, "�x", "�" * 3)
    assert (row["url"], row["no_url"], row["cited"]) == ("https://a.b/c?d=1", None, [2, 1, 12])
    assert (row["base"], row["no_base"], row["tie"], row["plain"]) == ("y.md", "s3://b/x/", 0.0312, 0.1234)
    assert (row["etag"], row["ext"], row["mime"]) == ("abc", "gz", "application/octet-stream")
