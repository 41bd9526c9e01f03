"""Rows of a database and raw records, through the ingest."""

import pytest
from pyspark.sql import functions as F

from freshet.config import BLUE, JobConfig
from freshet.operators.chunking import Chunkers, plain_pieces
from freshet.operators.embedding import HashedBagOfWords
from freshet.operators.extras import inline_records, reference_records
from freshet.plans.ingest import Ingest, summary
from freshet.plans.rows import sync_rows
from freshet.sources.snapshots import Snapshots

SMALL = JobConfig(chunk_size=40, chunk_overlap=5, dim=16)
ROWS = "id STRING, name STRING"
PLAIN = Chunkers(SMALL, {n: plain_pieces for n in ("markdown", "pdf", "csv", "text")})


def ingest_of(store):
    return Ingest(store, HashedBagOfWords("m1", 16), PLAIN)


def by_change(report):
    return {(r["change"], r["indexed"]): r["count"] for r in report.groupBy("change", "indexed").count().collect()}


# ---- rows of a database ---------------------------------------------------------------------------------------------

def test_snapshot_changes_equal_brute_force(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path / "s"), 4)
    old = {f"d{i}": f"h{i % 7}" for i in range(60)}
    new = {k: ("other" if i % 5 == 0 else v) for i, (k, v) in enumerate(old.items()) if i % 3} | {f"e{i}": "h" for i in range(9)}
    frames = [spark.createDataFrame(list(x.items()), "doc_id STRING, row_hash STRING") for x in (old, new)]
    first = snapshots.write(frames[0])
    assert snapshots.last() == 0 and {r["change"] for r in snapshots.changes(0, first).collect()} == {"insert"}
    snapshots.commit(first)
    second = snapshots.write(frames[1])
    assert (first, second, snapshots.last()) == (1, 2, 1)
    found = {(r["doc_id"], r["row_hash"], r["change"]) for r in snapshots.changes(first, second).collect()}
    expected = {(k, v, "insert" if k not in old else "update") for k, v in new.items() if old.get(k) != v}
    assert found == expected | {(k, v, "delete") for k, v in old.items() if k not in new}
    plan = snapshots.changes(first, second)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    with pytest.raises(Exception):
        snapshots.commit(first)  # somebody else was first


def test_snapshot_of_rows_that_repeat(spark, tmp_path):
    """Rows are grouped where they lie in their buckets, by one shuffle for both."""
    snapshots = Snapshots(spark, str(tmp_path / "s"), 4)
    rows = [("a", "h1"), ("a", "h3"), ("a", "h2"), ("b", "h1"), ("b", "h1"), ("c", None)]
    no = snapshots.write(spark.createDataFrame(rows, "doc_id STRING, row_hash STRING").repartition(3))
    assert sorted(map(tuple, snapshots.read(no).collect()), key=str) == [("a", "h3"), ("b", "h1"), ("c", None)]
    plan = snapshots.changes(0, no)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_sync_of_rows(spark, store):
    ingest, snapshots = ingest_of(store), Snapshots(spark, f"{store.root}/snapshots", 2)

    def sync(rows):
        return by_change(sync_rows(ingest, snapshots, spark.createDataFrame(rows, ROWS), "people", "id", ["id", "name"]))

    start = [("1", "Ann"), ("2", "Bo"), ("3", None), (None, "nobody")]
    assert sync(start) == {("insert", 1): 3}
    version = store.state(BLUE).batch
    assert sync(start) == {} and store.state(BLUE).batch == version
    # One revised, one gone, one new; a key that occurs twice is one document.
    assert sync([("1", "Ann"), ("2", "Bob"), ("4", "Di"), ("4", "Di")]) == {("update", 1): 1, ("delete", 0): 1, ("insert", 1): 1}
    rows = {r["source_uri"]: r["text"] for r in store.read(BLUE).collect()}
    assert set(rows) == {"people://1", "people://2", "people://4"} and '"name":"Bob"' in rows["people://2"]
    assert sync([]) == {("delete", 0): 3} and store.read(BLUE).count() == 0


def test_sync_of_rows_after_a_failure(spark, store):
    ingest, snapshots = ingest_of(store), Snapshots(spark, f"{store.root}/snapshots", 2)
    rows = spark.createDataFrame([("1", "Ann"), ("2", "Bo")], ROWS)
    # A sync that died after its snapshot was written, before it was committed.
    snapshots.write(rows.select(F.col("id").alias("doc_id"), F.lit("x").alias("row_hash")))
    assert by_change(sync_rows(ingest, snapshots, rows, "people", "id", ["name", "id"])) == {("insert", 1): 2}
    assert snapshots.last() == 1


# ---- raw records ----------------------------------------------------------------------------------------------------

def test_raw_records_of_both_kinds(spark, store):
    refs = spark.createDataFrame(
        [("b", "a.txt", "s3://b/a.txt", "e", 5, ""), ("b", "gone.txt", "s3://b/gone.txt", "e", 5, "")],
        "bucket STRING, key STRING, s3_uri STRING, etag STRING, size BIGINT, content_type STRING",
    )
    rows = spark.createDataFrame([("7", '{"t": 21}')], "id STRING, json STRING")
    raw = reference_records(refs).unionByName(inline_records(rows, "iot", F.col("id"), F.col("json"), topic="t"))
    bodies = spark.createDataFrame([("a.txt", b"alpha")], "key STRING, body BINARY")

    def fetch(wanted):
        return wanted.join(bodies, "key", "left").withColumn("content_type", F.lit(""))

    report = ingest_of(store).run_records(raw, fetch)
    assert {r["status"]: r["documents"] for r in summary(report).collect()} == {"indexed": 2, "missing": 1}
    found = {(r["source_uri"], r["text"]) for r in store.read(BLUE).collect()}
    assert found == {("s3://b/a.txt", "alpha"), ("iot://7", '{"t": 21}')}


def test_rows_of_one_version_with_two_types(spark, store):
    """Of rows with equal bodies the one whose extractor the report names is chunked."""
    rows = [("b", "k", kind, "# One\n\ntext") for kind in ("text/markdown", "", "text/plain")]
    objects = spark.createDataFrame(rows, "bucket STRING, key STRING, content_type STRING, body STRING")
    report = ingest_of(store).run(objects).collect()
    assert [r["extractor"] for r in report] == ["text"]
    assert {r["metadata"]["extractor"] for r in store.read(BLUE).collect()} == {"text"}
