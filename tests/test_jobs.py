import json
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from freshet.config import BLUE, GREEN, MEMORY, STAGING, JobConfig
from freshet.operators import checks, sync
from freshet.operators.chunking import Chunkers, plain_pieces
from freshet.operators.embedding import HashedBagOfWords
from freshet.operators.cells import is_built
from freshet.plans.ask import Asking, build_index, index_folder, retrieve
from freshet.plans.backfill import backfill, cutover
from freshet.plans.ingest import Ingest, ensure_tables, ingest_by_target, resync, summary
from freshet.sources.files import fetch_objects, markdown_tree, read_objects
from freshet.sources.pointer import get_active
from freshet.sources.shared import shared_dir
from freshet.streaming.ingest import ingest_landed, ingest_stream
from freshet.streaming.landing import account, file_events, follow, land, land_stream, latest, rejected

SMALL = JobConfig(chunk_size=10, chunk_overlap=2, dim=16)


def objects(spark, **bodies):
    rows = [("b", k.replace("_", "."), "", v) for k, v in bodies.items()]
    return spark.createDataFrame(rows, "bucket STRING, key STRING, content_type STRING, body STRING")


def ingest_of(store, model="m1", **more):
    return Ingest(store, HashedBagOfWords(model, 16), Chunkers(SMALL), **more)


def outcome(report):
    return {r["status"]: (r["documents"], r["chunks"]) for r in summary(report).collect()}


def content(store, name=BLUE):
    rows = store.read(name).select("source_uri", "ordinal", "text", "model").collect()
    return sorted((r["source_uri"][7:], r["ordinal"], r["text"], r["model"]) for r in rows)


# ---- tables ---------------------------------------------------------------------------------------------------------

def test_tables_by_batch(spark, store):
    assert store.ensure("t", "k STRING, v INT", "k", ("k",)) and not store.ensure("t", "k STRING, v INT", "k")
    assert store.read("t").count() == 0
    rows = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    assert store.replace("t", rows, rows) == 1 and store.state("t").voided == 0  # nothing was there before
    one = rows.where("k in ('k7', 'k8')").withColumn("v", F.lit(-1))
    assert store.replace("t", one, one) == 2 and store.state("t").voided == 2
    assert store.read("t").where("v = -1").count() == 2 and store.read("t").count() == 40
    assert store.read("t", 1).where("v = -1").count() == 0
    # The rows of a change may come from the table itself; keys without rows go; unknown ones change nothing.
    store.replace("t", one, store.read("t").where("k in ('k7', 'k8')").withColumn("v", F.lit(-2)))
    assert store.replace("t", rows.where("k = 'k9'"), None) == 4 == store.replace("t", rows.limit(0), None)
    assert sorted(r["v"] for r in store.read("t").where("v < 0").collect()) == [-2, -2] and store.read("t").count() == 39
    store.append("t", spark.createDataFrame([("new", 99), ("k1", 100)], "k STRING, v INT"))
    assert store.read("t").where("k = 'k1'").count() == 2 and store.read("t").count() == 41
    with pytest.raises(Exception):
        store._commit("t", store.state("t"))  # somebody else wrote this batch first


def test_batches_without_a_commit_are_not_there(spark, store):
    store.ensure("t", "k STRING, v INT", "k")
    frame = lambda *rows: spark.createDataFrame(rows, "k STRING, v INT")
    store.replace("t", frame(("a", 1)), frame(("a", 1), ("b", 1)))
    real, store._commit = store._commit, lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver"))
    with pytest.raises(RuntimeError):
        store.replace("t", frame(("a", 2)), frame(("a", 2), ("c", 2)))
    store._commit = real
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 1), ("b", 1)]
    store.replace("t", frame(("b", 0)), None)  # takes the same number and leaves nothing of the attempt
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 1)]
    with pytest.raises(ValueError, match="negative"):
        store.replace("t", frame(("a", 0)), frame(("a", -5)), {"negative": F.col("v") < 0})
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 1)]


def test_tables_are_copied_when_much_is_void(spark, store):
    store.ensure("t", "k STRING, v INT", "k", ("k",))
    rows = spark.range(20).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    store.replace("t", rows, rows)
    assert not store.maintain("t")
    store.replace("t", rows.limit(9), rows.limit(9))
    before = sorted(map(tuple, store.read("t").collect()))
    assert store.maintain("t") and store.state("t").since_base == 0 and not store.maintain("t")
    assert sorted(map(tuple, store.read("t").collect())) == before == sorted(map(tuple, store.read("t", 2).collect()))
    assert store.clean("t") == 3 and sorted(map(tuple, store.read("t").collect())) == before
    for n in range(3):
        store.append("t", rows.limit(1))
    assert not store.maintain("t", batches=4) and store.maintain("t", batches=3) and store.read("t").count() == 23


def test_a_small_change_writes_only_what_changed(spark, store):
    texts = {f"d{i}_txt": f"document number {i} has words" for i in range(40)}
    ingest = ingest_of(store)
    ingest.run(objects(spark, **texts))
    assert outcome(ingest.run(objects(spark, **{**texts, "d3_txt": "other words here"}))) == {"indexed": (1, 2), "unchanged": (39, 0)}
    assert store.state(BLUE).voided == 1 and store.state(BLUE).n_rows == 2
    assert "BroadcastHashJoin" in plan_of(store.read(BLUE)) and "SortMergeJoin" not in plan_of(store.read(BLUE))


def test_a_wrong_dimension_stops_an_ingest(spark, store):
    class Wrong(HashedBagOfWords):
        def embed(self, text, kind="document"):
            return F.slice(super().embed(text, kind), 1, 7)

    ingest_of(store).run(objects(spark, a_txt="good words"))
    before = content(store)
    with pytest.raises(ValueError, match="not of size 16"):
        Ingest(store, Wrong("m1", 16), Chunkers(SMALL)).run(objects(spark, a_txt="bad words", b_txt="more"))
    assert content(store) == before


def test_shared_folder_is_the_named_one():
    def session(master, folder):
        conf, context = SimpleNamespace(get=lambda *_: folder), SimpleNamespace(master=master)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_dir(session("spark://host", "s3a://team/tmp/"), "x").startswith("s3a://team/tmp/x-")
    assert "/x-" in shared_dir(session("local[2]", None), "x")
    with pytest.raises(ValueError):
        shared_dir(session("spark://host", None), "x")


def test_files(spark, tmp_path):
    for name, text in {"a.md": "# A", "sub/b.MDX": "b", ".git/c.md": "no", "d.csv": "h\n1"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    assert [r["key"] for r in markdown_tree(spark, str(tmp_path), "/p/").collect()] == ["p/a.md", "p/sub/b.MDX"]
    types = spark.createDataFrame([("d.csv", "text/special")], "key STRING, content_type STRING")
    got = {r["key"]: (r["content_type"], bytes(r["body"])) for r in read_objects(spark, str(tmp_path), "b", types).collect()}
    assert got["d.csv"] == ("text/special", b"h\n1") and got["sub/b.MDX"] == ("application/octet-stream", b"b")


def test_only_named_objects_are_fetched(spark, tmp_path):
    (tmp_path / "b" / "x").mkdir(parents=True)
    (tmp_path / "b" / "x" / "é +.md").write_bytes(b"\xff one")
    (tmp_path / "b" / "two.txt").write_bytes(b"")
    refs = spark.createDataFrame(
        [("b", "x/é +.md", "e1"), ("b", "gone.md", ""), ("b", "two.txt", "")], "bucket STRING, key STRING, etag STRING"
    )
    rows = fetch_objects(refs, f"file://{tmp_path}").collect()
    got = {r["key"]: (r["body"] and bytes(r["body"]), r["etag"], r["content_type"]) for r in rows}
    assert got == {
        "x/é +.md": (b"\xff one", "e1", "text/markdown"), "two.txt": (b"", "", "text/plain"), "gone.md": (None, "", "text/markdown")
    }


# ---- ingest ---------------------------------------------------------------------------------------------------------

def test_ingest_versions(spark, store):
    ingest = ingest_of(store)
    first = objects(spark, a_txt="one two three four five", b_txt="short", c_txt="")
    assert outcome(ingest.run(first)) == {"indexed": (2, 4), "empty": (1, 0)}
    loaded = content(store)
    assert [(k, o) for k, o, _, _ in loaded] == [("a.txt", 0), ("a.txt", 1), ("a.txt", 2), ("b.txt", 0)]
    assert outcome(ingest.run(first)) == {"unchanged": (2, 0), "empty": (1, 0)} and content(store) == loaded
    assert store.read(STAGING).count() == 0

    # shorter: no stale tail; empty: old chunks stay
    later = objects(spark, a_txt="only", b_txt=" ")
    assert outcome(ingest.run(later)) == {"indexed": (1, 1), "empty": (1, 0)}
    assert [(k, o, t) for k, o, t, _ in content(store)] == [("a.txt", 0, "only"), ("b.txt", 0, "short")]
    assert outcome(ingest_of(store, prune_empty=True).run(later)) == {"unchanged": (1, 0), "empty": (1, 0)}
    assert [k for k, *_ in content(store)] == ["a.txt"]

    # back to the first version
    ingest.run(first)
    assert content(store) == loaded
    table = store.read(BLUE)
    assert checks.duplicate_chunk_ids(table).count() == 0 and checks.wrong_dimensions(table, 16).count() == 0


def test_resume_does_not_embed_twice(spark, store):
    """A job that died between two commits of embeddings goes on where it stopped."""
    ensure_tables(store)
    texts = {f"d{i}_txt": f"document number {i} has words" for i in range(12)}
    died = ingest_of(store, commits=3)
    calls = []

    def fail_on_second(name, keys, rows, checks=None, real=store.replace):
        calls.append(name)
        if len(calls) == 3:  # staging, first part of the embeddings, second part
            raise RuntimeError("lost driver")
        return real(name, keys, rows, checks)

    store.replace = fail_on_second
    with pytest.raises(RuntimeError):
        died.run(objects(spark, **texts))
    del store.replace
    left = sync.needs_embedding(store.read(STAGING), "m1").count()
    assert 0 < left < store.read(STAGING).count() and store.read(BLUE).count() == 0

    embedded = spark.sparkContext.accumulator(0)

    class Counting(HashedBagOfWords):
        def embed(self, text, kind="document"):
            @F.pandas_udf("string")
            def count(s):
                embedded.add(len(s))
                return s

            return super().embed(count(text), kind)

    report = Ingest(store, Counting("m1", 16), Chunkers(SMALL)).run(objects(spark, **texts))
    assert outcome(report)["indexed"][0] == 12 and embedded.value == left
    assert checks.duplicate_chunk_ids(store.read(BLUE)).count() == 0


def test_raw_records_and_missing_chunks(spark):
    from freshet.operators.extras import inline_records, raw_documents, reference_records

    refs = spark.createDataFrame([("b", "k", "s3://b/k", "", 1, "")], "bucket STRING, key STRING, s3_uri STRING, etag STRING, size BIGINT, content_type STRING")
    rows = spark.createDataFrame([("7", '{"x":1}')], "id STRING, json STRING")
    raw = reference_records(refs).unionByName(inline_records(rows, "rdbms", F.col("id"), F.col("json"), table="t"))
    objects_ = spark.createDataFrame([("b", "k", "text"), ("b", "other", "no")], "bucket STRING, key STRING, body STRING")
    got = {(r["source"], r["source_uri"], r["body"]) for r in raw_documents(raw, objects_).collect()}
    assert got == {("s3", "s3://b/k", "text"), ("rdbms", "rdbms://7", '{"x":1}')}
    wanted = spark.createDataFrame([("a:0",), ("a:1",)], "chunk_id STRING")
    assert [r["chunk_id"] for r in sync.missing_chunks(wanted, wanted.limit(1)).collect()] == ["a:1"]


def test_targets_and_resync(spark, store):
    ingest = ingest_of(store)
    docs = objects(spark, a_txt="alpha", b_txt="beta").withColumn("target", F.concat(F.substring("key", 1, 1), F.lit("_knowledge")))
    assert sorted(ingest_by_target(ingest, docs)) == ["a_knowledge", "b_knowledge"]
    assert content(store, "a_knowledge")[0][:3] == ("a.txt", 0, "alpha")
    assert outcome(resync(ingest, objects(spark, x_txt="gamma", y_txt="delta"), "x")) == {"indexed": (1, 1)}


def test_backfill_cutover_rollback_and_questions(spark, store):
    ingest = ingest_of(store)
    ingest.run(objects(spark, a_txt="red apples", b_txt="green pears", c_txt="blue sky"))
    asking = Asking(store, lambda model, dim: HashedBagOfWords(model, dim), config=JobConfig(model="m1", dim=16))
    asked = spark.createDataFrame([("1", "green pears?"), ("2", "  ")], "query_id STRING, query STRING")

    answers = {r["query_id"]: r for r in asking.ask(asked, 3, 2).collect()}
    assert answers["1"]["sources"][0]["s3_uri"] == "s3://b/b.txt" and len(answers["1"]["sources"]) == 2
    assert answers["1"]["active_collection"] == BLUE and answers["2"]["sources"] == []

    new = HashedBagOfWords("m2", 8)
    done = backfill(store, new, commits=2)
    assert done == {"status": "complete", "processed": store.read(BLUE).count(), "model": "m2", "target": GREEN}
    assert {(r["model"], r["dim"]) for r in store.read(GREEN).collect()} == {("m2", 8)}
    version = store.state(GREEN).batch
    assert backfill(store, new)["processed"] == 0 and store.state(GREEN).batch == version  # nothing left to embed

    assert get_active(store)["active_collection"] == BLUE
    assert cutover(store) == {"active_collection": GREEN, "active_index": "chunk_vectors", "model": "m2", "dim": 8}
    logged = store.read(MEMORY).count()
    moved = asking.ask(asked.where("query_id = '1'"), 3, 2)
    first = moved.first()
    assert logged == 2 and store.read(MEMORY).count() == 3
    assert first["active_collection"] == GREEN and first["model"] == "m2" and first["sources"][0]["s3_uri"] == "s3://b/b.txt"
    assert [s["chunk_id"] for s in first["sources"]] in [r["sources"] for r in store.read(MEMORY).collect()]
    asking.ask(asked, 3, 2, log=False)
    assert store.read(MEMORY).count() == 3

    ingest.run(objects(spark, d_txt="new words"), "active")
    assert "d.txt" in [k for k, *_ in content(store, GREEN)] and "d.txt" not in [k for k, *_ in content(store)]
    assert cutover(store, BLUE)["model"] == "m1"
    assert cutover(store, "empty_table") == {"active_collection": "empty_table", "active_index": "chunk_vectors", "model": "hashed-bow-1", "dim": 1024}


def test_backfill_goes_on_where_it_stopped(spark, store):
    ingest_of(store).run(objects(spark, **{f"d{i}_txt": f"document number {i} has words" for i in range(12)}))
    total = store.read(BLUE).count()
    new, calls = HashedBagOfWords("m2", 8), []

    def fail_later(name, keys, rows, checks=None, real=store.replace):
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("lost driver")
        return real(name, keys, rows, checks)

    store.replace = fail_later
    with pytest.raises(RuntimeError):
        backfill(store, new, commits=4)
    del store.replace
    left = total - store.read(GREEN).count()
    assert 0 < left < total
    assert backfill(store, new, commits=4)["processed"] == left
    key = lambda r: (r["chunk_id"], r["text"], r["ordinal"], r["content_hash"])
    assert sorted(map(key, store.read(GREEN).collect())) == sorted(map(key, store.read(BLUE).collect()))
    # One document changes: only its chunks are embedded again.
    ingest_of(store).run(objects(spark, d3_txt="other words"))
    assert backfill(store, new, commits=4)["processed"] == store.read(BLUE).where("source_uri = 's3://b/d3.txt'").count()


def test_questions_through_an_inverted_file(spark, store):
    """The index of the present version is searched; an ingest makes it stale, and searches are exact again."""
    ingest = ingest_of(store)
    ingest.run(objects(spark, **{f"d{i}_txt": f"word{'abcdefghij'[i]} apples" for i in range(10)}))
    asking = Asking(store, lambda model, dim: HashedBagOfWords(model, dim), config=JobConfig(model="m1", dim=16))
    asked = spark.createDataFrame([("1", "wordc apples?"), ("2", " ")], "query_id STRING, query STRING")
    exact = asking.ask(asked, 3, 2).collect()
    path = build_index(store, BLUE, 16, cells=3, probes=3)
    assert is_built(spark, path) and path == index_folder(store, BLUE)
    assert asking.ask(asked, 3, 2).collect() == exact
    # A plan that reads the index names its folder; with one cell of three it may miss hits, but not the nearest.
    hits = retrieve(store.read(BLUE), asked, HashedBagOfWords("m1", 16), 3, path)
    assert "/_cells/" in str(hits.inputFiles()) and hits.count() == 3
    build_index(store, BLUE, 16, cells=3, probes=1)
    assert asking.ask(asked.where("query_id = '1'"), 1, 1).first()["sources"][0]["s3_uri"] == "s3://b/d2.txt"
    ingest.run(objects(spark, n_txt="wordc,  apples"))
    assert not is_built(spark, index_folder(store, BLUE))
    assert "s3://b/n.txt" in [s["s3_uri"] for s in asking.ask(asked.where("query_id = '1'"), 3, 2).first()["sources"]]


def test_answers_with_a_model_search_once(spark, store):
    ingest_of(store).run(objects(spark, a_txt="red apples", b_txt="green pears"))
    asking = Asking(
        store, lambda model, dim: HashedBagOfWords(model, dim), answerer=lambda p: F.upper(p), config=JobConfig(model="m1", dim=16)
    )
    asked = spark.createDataFrame([("1", "green pears?")], "query_id STRING, query STRING")
    row = asking.ask(asked, 2, 2).first()
    blocks = [f"[{s['n']}] (source: {s['s3_uri']})\n{s['text']}" for s in row["sources"]]
    assert row["answer"] == ("Question: green pears?\n\nSources:\n" + "\n\n".join(blocks)).upper()



# ---- streams --------------------------------------------------------------------------------------------------------

def notification(key, offset):
    value = {"Key": f"b/{key}", "Records": [{"eventName": "s3:ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": key, "size": offset}}}]}
    return {"offset": offset, "value": json.dumps(value)}


def write_events(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(e) for e in events))


def test_landing_stream_keeps_the_latest_and_accounts_for_all(spark, tmp_path):
    folder, root, checkpoint = tmp_path / "in", str(tmp_path / "landing"), str(tmp_path / "ck")
    write_events(folder, "1.json", [notification("a", 1), notification("b", 2), {"offset": 3, "value": "broken"}])
    write_events(folder, "2.json", [notification("a", 4), notification("a", 0), {"offset": 7, "value": '{"x":1}'}])
    assert latest(spark, root).count() == account(spark, root).count() == rejected(spark, root).count() == 0
    land_stream(file_events(spark, str(folder), 1), root, checkpoint).awaitTermination()
    write_events(folder, "3.json", [notification("b", 6), notification("c", 5)])  # while nothing is running
    land_stream(file_events(spark, str(folder), 1), root, checkpoint).awaitTermination()
    want = {"b/a": 4, "b/b": 6, "b/c": 5}
    assert {r["landing_key"]: r["offset"] for r in latest(spark, root).collect()} == want
    told = sorted((r["batch"], r["input"], r["landed"], r["superseded"], r["rejected"]) for r in account(spark, root).collect())
    assert told == [(0, 3, 2, 0, 1), (1, 3, 1, 1, 1), (2, 2, 2, 0, 0)]
    assert sorted((r["offset"], r["reason"]) for r in rejected(spark, root).collect()) == [(3, "not JSON"), (7, "no key")]
    # A batch that is repeated after a failure replaces itself.
    again = spark.createDataFrame([(6, notification("b", 6)["value"]), (5, notification("c", 5)["value"])], "offset BIGINT, value STRING")
    assert land(again, root, 2) == {"batch": 2, "input": 2, "landed": 2, "superseded": 0, "rejected": 0, "reasons": {}}
    assert {r["landing_key"]: r["offset"] for r in latest(spark, root).collect()} == want and account(spark, root).count() == 3


def test_change_feed_tells_inserts_from_replacements(spark, tmp_path):
    """Over two runs from one checkpoint; what comes too late is no change, and a batch that is landed again neither."""
    root, seen = str(tmp_path / "landing"), []
    batch = lambda *keys: spark.createDataFrame([(o, notification(k, o)["value"]) for k, o in keys], "offset BIGINT, value STRING")
    run = lambda: follow(spark, root, lambda feed: seen.append(sorted((r["landing_key"], r["offset"], r["op"], json.loads(r["value"])["Key"]) for r in feed.collect())), str(tmp_path / "ck")).awaitTermination()
    land(batch(("a", 1), ("b", 5), ("a", 3)), root, 0)
    run()
    land(batch(("a", 4), ("b", 2), ("c", 6)), root, 1)
    run()
    land(batch(("a", 4), ("b", 2), ("c", 6)), root, 1)
    run()
    assert [s for s in seen if s] == [
        [("b/a", 3, "insert", "b/a"), ("b/b", 5, "insert", "b/b")],
        [("b/a", 4, "replace", "b/a"), ("b/c", 6, "insert", "b/c")],
    ]


def test_change_feed_is_kept_by_spark_itself(spark, tmp_path):
    """No Python function is called per key, and equal places are no change, whichever batch lands them again."""
    from freshet.streaming.landing import changes, landed_stream

    root, seen = str(tmp_path / "landing"), []
    batch = lambda *keys: spark.createDataFrame([(o, notification(k, o)["value"]) for k, o in keys], "offset BIGINT, value STRING")
    land(batch(*[(f"k{i}", i) for i in range(200)]), root, 0)
    plan = changes(landed_stream(spark, root))._jdf.queryExecution().logical().toString()
    assert "Aggregate" in plan and "Pandas" not in plan
    run = lambda: follow(spark, root, lambda feed: seen.append(sorted((r["op"], r["batch"], r["offset"]) for r in feed.collect())), str(tmp_path / "ck")).awaitTermination()
    run()
    land(batch(("k7", 7), ("k8", 300), ("k9", 2), ("new", 1)), root, 1)
    run()
    assert [s for s in seen if s] == [[("insert", 0, i) for i in range(200)], [("insert", 1, 1), ("replace", 1, 300)]]


def test_named_objects_by_every_way(spark, monkeypatch):
    """Few names, few others, no others, many of both: the same rows, the first three ways without a shuffle of bodies."""
    from freshet.sources import files

    rows = [("b", f"{i}", f"text {i}") for i in range(12)] + [("b", "3", "text 3"), (None, "1", "x"), ("b", None, "y")]
    table = spark.createDataFrame(rows, "bucket STRING, key STRING, body STRING").coalesce(2)
    marked = []
    for limit, names in ((5, [1, 3, 99]), (5, range(2, 12)), (5, range(12)), (2, range(6))):
        monkeypatch.setattr(files, "SLIM_ROWS", limit)
        found = files.named_objects(spark.createDataFrame([("b", str(n)) for n in names], "bucket STRING, key STRING"), table)
        assert sorted(r["body"] for r in found.collect()) == sorted(t for b, k, t in rows if b and k and int(k) in names)
        plan = str(found._jdf.queryExecution().analyzed())
        marked.append("broadcast" if "ResolvedHint (strategy=broadcast)" in plan else "shuffled" if "Join" in plan else "none")
    assert marked == ["broadcast", "broadcast", "none", "shuffled"]


def test_many_changed_versions_are_looked_for_by_hash_first(spark, store, monkeypatch):
    """Beyond what is broadcast whole, hashes of versions leave out the other bodies before the shuffle."""
    from freshet.plans import ingest as plan

    used, real = [], plan.likely
    monkeypatch.setattr(plan, "likely", lambda *args: used.append(1) or real(*args))
    for module in (plan, sys.modules["freshet.functions.sizes"]):
        monkeypatch.setattr(module, "SLIM_ROWS", 2)
    texts = {f"d{i}_txt": f"words {i}" for i in range(9)}
    ingest = ingest_of(store)
    ingest.run(objects(spark, **texts))
    assert not used
    later = {**texts, **{f"d{i}_txt": f"other {i}" for i in range(4)}}
    assert outcome(ingest.run(objects(spark, **later))) == {"indexed": (4, 4), "unchanged": (5, 0)}
    assert used and sorted(t for _, _, t, _ in content(store)) == sorted(later.values())


def test_ingest_follows_what_landed(spark, store, tmp_path):
    root, reports = str(tmp_path / "landing"), []
    bodies = objects(spark, a_txt="first words", b_txt="second")
    ingest = ingest_of(store)
    run = lambda: ingest_landed(spark, root, bodies, ingest, str(tmp_path / "ck"), on_report=lambda r: reports.append(outcome(r))).awaitTermination()
    events = [(1, notification("a.txt", 1)["value"]), (2, notification("a.txt", 2)["value"]), (3, "broken")]
    land(spark.createDataFrame(events, "offset BIGINT, value STRING"), root, 0)
    run()
    land(spark.createDataFrame([(4, notification("b.txt", 4)["value"]), (0, notification("a.txt", 0)["value"])], "offset BIGINT, value STRING"), root, 1)
    run()
    assert reports == [{"indexed": (1, 2)}, {"indexed": (1, 1)}]  # the late event of a.txt starts nothing


def test_documents_stream_from_a_file_and_from_a_folder(spark, tmp_path):
    """A table stored as a folder of files is streamed like one that is a single file."""
    from freshet.catalog import all_queries
    from freshet.catalog.inputs import table

    whole = "/root/testdata/sf0.001"
    some = table(spark, whole, "documents").where("doc_id < 40")
    some.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    some.coalesce(1).write.parquet(str(tmp_path / "out"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "out").glob("part-*.parquet")).rename(tmp_path / "one" / "documents.parquet")
    query = all_queries()["stream_latest_per_key"]
    found = [sorted(query.run(spark, str(tmp_path / d)).select("landing_key", "offset").collect()) for d in ("one", "many")]
    assert found[0] and found[0] == found[1]


def test_a_stream_that_goes_on(spark, tmp_path):
    """With an interval as trigger the stream stays up and takes what comes later."""
    folder, root = tmp_path / "in", str(tmp_path / "landing")
    write_events(folder, "1.json", [notification("a", 1)])
    query = land_stream(file_events(spark, str(folder), 1), root, str(tmp_path / "ck"), {"processingTime": "0 seconds"})
    query.processAllAvailable()
    write_events(folder, "2.json", [notification("b", 2)])
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert {r["landing_key"] for r in latest(spark, root).collect()} == {"b/a", "b/b"}


def test_ingest_stream_resumes(spark, store, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    bodies = objects(spark, a_txt="first words", b_txt="second", c_txt="third")
    (tmp_path / "bucket" / "b").mkdir(parents=True)
    for row in bodies.collect():
        (tmp_path / "bucket" / "b" / row["key"]).write_text(row["body"])
    fetch = lambda refs: fetch_objects(refs, f"file://{tmp_path}/bucket")
    ingest, reports = ingest_of(store), []
    run = lambda: ingest_stream(file_events(spark, str(folder), 1), fetch, ingest, checkpoint, on_report=lambda r: reports.append(outcome(r))).awaitTermination()
    write_events(folder, "1.json", [notification("a.txt", 1), notification("b.txt", 2), notification("a.txt", 3), notification("gone.txt", 4)])
    run()
    write_events(folder, "2.json", [notification("c.txt", 5), notification("a.txt", 6)])
    run()
    run()  # nothing new: no batch at all
    assert reports == [{"indexed": (2, 3), "missing": (1, 0)}, {"indexed": (1, 1), "unchanged": (1, 0)}]
    assert [k for k, *_ in content(store)] == ["a.txt", "a.txt", "b.txt", "c.txt"]
    other = ingest_of(type(store)(spark, str(tmp_path / "batch")))
    other.run(bodies)
    assert content(other.store) == content(store)


def test_tumbling_window_stream(spark, tmp_path):
    from freshet.operators.extras import batch_readings

    spark.createDataFrame(
        [(i, f"2024-01-01 00:{i:02d}:00", "s") for i in range(40)], "no BIGINT, ts STRING, device STRING"
    ).coalesce(1).write.json(str(tmp_path / "in"))
    spark.createDataFrame([(99, "2024-01-02 00:00:00", "s")], "no BIGINT, ts STRING, device STRING").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema("no BIGINT, ts TIMESTAMP, device STRING").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    batches = batch_readings(stream.withWatermark("ts", "5 minutes"), "15 minutes", ["device"], "no", F.col("no").cast("string"), span=10)
    batches.writeStream.format("memory").queryName("batches").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted((str(r["window_start"])[11:16], r["part"], r["readings"]) for r in spark.table("batches").collect())
    assert got == [("00:00", 0, 10), ("00:00", 1, 5), ("00:15", 1, 5), ("00:15", 2, 10), ("00:30", 3, 10)]


# ---- plans ----------------------------------------------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_not_shuffled(spark):
    """Chunking is map-only; applying a small change does not shuffle the old table."""
    docs = spark.range(10).select(F.lit("d").alias("doc_id"), F.lit("u").alias("source_uri"), F.lit("h").alias("doc_content_hash"), F.lit("text").alias("body"))
    from freshet.operators.chunking import finish

    chunks = finish(docs.withColumn("pieces", plain_pieces(F.col("body"), F.lit(None), SMALL)), extractor=F.lit("text"))
    assert "Exchange" not in plan_of(chunks)
    table = spark.range(1000).select(F.col("id").cast("string").alias("doc_id"), F.lit("x").alias("text"))
    after = sync.apply_documents(table, F.broadcast(table.limit(5)), table.limit(5))
    assert "SortMergeJoin" not in plan_of(after) and "BroadcastHashJoin" in plan_of(after)


def test_hot_document_is_split_when_both_sides_are_large(spark):
    """One document holds most of the old rows and the changed side is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text")
        )
        applied = spark.range(5000).select((F.col("id") * 3).cast("string").alias("doc_id"))
        kept = rows.join(applied, "doc_id", "left_anti").select("doc_id", "text")
        assert len(kept.collect()) == 55000
        assert "skew=true" in plan_of(kept)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_versions_are_looked_up_where_they_are_written(spark, store):
    ingest = Ingest(store, HashedBagOfWords(dim=16))
    row = lambda body, key="k": ("b", key, "", body)
    frame = lambda *rows: spark.createDataFrame(rows, "bucket STRING, key STRING, content_type STRING, body STRING")

    def status(target, *rows):
        return [r["status"] for r in ingest.run(frame(*rows), target).orderBy("doc_id").collect()]

    def indexed(target):
        return sorted(r["text"] for r in store.read(target).collect())

    assert status("knowledge", row("one")) == ["indexed"]
    assert status("t_knowledge", row("one")) == ["indexed"] and indexed("t_knowledge") == ["one"]
    assert status("t_knowledge", row("two")) == ["indexed"]
    assert status("t_knowledge", row("one")) == ["indexed"] and indexed("t_knowledge") == ["one"]
    assert status("knowledge", row("one")) == ["unchanged"]


def test_a_first_load_leaves_no_staged_row_void(spark, store):
    """What is embedded takes the place of all that was staged, so later steps leave out no rows by a join."""
    from freshet.config import BLUE, STAGING

    objects = spark.createDataFrame([("b", f"{n}.txt", "", f"text {n}") for n in range(5)], "bucket STRING, key STRING, content_type STRING, body STRING")
    Ingest(store, HashedBagOfWords("m", 8)).run(objects)
    assert store.read(BLUE).count() == 5 and store.read(STAGING).count() == 0
    assert store.commits(STAGING).agg(F.sum("voided")).first()[0] == 0


def test_staged_rows_do_not_stay_on_the_disk(spark, store):
    """What is embedded takes the place of the rows without vectors, and what is indexed leaves staging, files included."""
    from pathlib import Path

    from freshet.config import BLUE, STAGING

    folders, seen = lambda: sorted(p.name for p in Path(store.root, STAGING, "rows").glob("batch=*")), []

    class Watched(Ingest):
        def apply(self, *args):
            seen.append(folders())
            super().apply(*args)

    objects = [("b", f"{n}.txt", "", f"text {n}") for n in range(5)]
    ddl = "bucket STRING, key STRING, content_type STRING, body STRING"
    for rows in (objects, [*objects[:3], ("b", "3.txt", "", "other")]):
        Watched(store, HashedBagOfWords("m", 8)).run(spark.createDataFrame(rows, ddl))
    assert seen == [["batch=2"], ["batch=5"]] and folders() == ["batch=6"]
    assert sorted(r["text"] for r in store.read(BLUE).collect()) == ["other", "text 0", "text 1", "text 2", "text 4"]


def test_nothing_is_shuffled_to_be_compared_with_an_empty_table(spark, store):
    store.ensure("t", "doc_id STRING, doc_content_hash STRING", "doc_id")
    versions = spark.createDataFrame([("a", "1"), ("b", "2")], "doc_id STRING, doc_content_hash STRING")
    changed = sync.changed_versions(versions, store.read("t"))
    assert store.is_empty("t") and changed.count() == 2 and "Exchange" not in plan_of(changed) and "Join" not in plan_of(changed)
    store.append("t", versions.limit(1))
    assert not store.is_empty("t") and sync.changed_versions(versions, store.read("t")).count() == 1


def test_repeated_and_missing_objects(spark, store):
    ingest = Ingest(store, HashedBagOfWords(dim=16))
    rows = [("b", "k", "", "one"), ("b", "k", "", "one"), ("b", "m", "", None)]
    docs = spark.createDataFrame(rows, "bucket STRING, key STRING, content_type STRING, body STRING")
    report = ingest.run(docs).collect()
    assert sorted(r["status"] for r in report) == ["indexed", "missing"]
    assert [r["text"] for r in store.read("knowledge").collect()] == ["one"]
