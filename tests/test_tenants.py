"""One ingest for all tenants."""

import pytest
from pyspark.sql import functions as F

from freshet.config import JobConfig
from freshet.operators.chunking import Chunkers, plain_pieces
from freshet.operators.embedding import HashedBagOfWords
from freshet.plans import tenants as plan
from freshet.plans.tenants import TENANT_STAGING, TENANTS, TenantIngest

SMALL = JobConfig(chunk_size=10, chunk_overlap=0, dim=16)
PLAIN = Chunkers(SMALL, {n: plain_pieces for n in ("markdown", "pdf", "csv", "text")})


def tenants(store, model="m1", dim=16):
    return TenantIngest(store, HashedBagOfWords(model, dim), PLAIN)


def objects(spark, *rows):
    return spark.createDataFrame(
        [(t, "b", k, "", v) for t, k, v in rows], "target STRING, bucket STRING, key STRING, content_type STRING, body STRING"
    )


def told(report):
    rows = report.groupBy("target", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("indexed").alias("chunks")).collect()
    return {(r["target"], r["status"]): (r["n"], r["chunks"]) for r in rows}


def held(store, target):
    rows = store.read(TENANTS).where(F.col("target") == target).orderBy("source_uri", "ordinal").collect()
    return [(r["source_uri"][7:], r["text"]) for r in rows]


def test_targets_versions_and_defaults(spark, store):
    ingest = tenants(store)
    first = objects(
        spark, ("a", "x", "alpha betagamma"), ("b", "x", "alpha betagamma"), ("a", "y", "one"), (None, "z", "two"), ("", "w", "six"),
        ("a", "gone", None),
    )
    assert told(ingest.run(first)) == {
        ("a", "indexed"): (2, 3), ("a", "missing"): (1, 0), ("b", "indexed"): (1, 2), ("knowledge", "indexed"): (2, 2),
    }
    assert held(store, "a") == [("x", "alpha beta"), ("x", "gamma"), ("y", "one")] and held(store, "b") == held(store, "a")[:2]
    batch = store.state(TENANTS).batch
    assert {s for _, s in told(ingest.run(first))} == {"unchanged", "missing"} and store.state(TENANTS).batch == batch
    # A shorter version in one target leaves the other alone; a version that comes back is indexed again.
    assert told(ingest.run(objects(spark, ("a", "x", "new"), ("b", "y", "")))) == {("a", "indexed"): (1, 1), ("b", "empty"): (1, 0)}
    assert held(store, "a") == [("x", "new"), ("y", "one")] and len(held(store, "b")) == 2
    assert told(ingest.run(objects(spark, ("a", "x", "alpha betagamma")))) == {("a", "indexed"): (1, 2)}
    assert held(store, "a") == [("x", "alpha beta"), ("x", "gamma"), ("y", "one")]
    assert ingest.chunks("b").count() == 2 and "target" not in ingest.chunks("b").columns
    plan = ingest.chunks("b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "target" in plan.split("PartitionFilters")[1].split("]")[0]


def test_two_versions_of_one_document_and_repeated_rows(spark, store):
    ingest = tenants(store)
    rows = [("a", "x", "first"), ("b", "x", "second"), ("b", "x", "second"), ("c", "x", "first"), ("c", "x", "second")]
    report = ingest.run(objects(spark, *rows))
    assert told(report) == {(t, "indexed"): (1, 1) for t in "abc"}
    # Of two versions in one target the one with the larger hash stays.
    assert [held(store, t)[0][1] for t in "ab"] == ["first", "second"] and len(held(store, "c")) == 1
    assert told(ingest.run(objects(spark))) == {}


def test_a_run_that_died_goes_on(spark, store):
    ingest = tenants(store)
    docs = objects(spark, ("a", "x", "alpha"), ("b", "x", "alpha"), ("b", "y", "beta"))
    apply, ingest.apply = ingest.apply, lambda changed: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        ingest.run(docs)
    # Both targets' copies were staged as one.
    assert store.read(TENANT_STAGING).count() == 2 and store.read(TENANTS).count() == 0
    batch = store.state(TENANT_STAGING).batch
    ingest.apply = apply
    assert told(ingest.run(docs)) == {("a", "indexed"): (1, 1), ("b", "indexed"): (2, 2)}
    # The second run wrote no staged rows of its own; it only cleared them.
    assert store.read(TENANT_STAGING).count() == 0 and store.state(TENANT_STAGING).batch == batch + 1


@pytest.mark.parametrize("limit", [0, 1])
def test_bodies_and_vectors_of_a_large_load_are_not_shuffled(spark, store, monkeypatch, limit):
    # With a limit of one name, four are many and the one that is left out is few; with none, everything is many.
    monkeypatch.setattr(plan, "NAME_ROWS", limit)
    monkeypatch.setattr(plan, "SLIM_ROWS", limit)
    ingest, seen = tenants(store), []
    only, dealt = ingest.only_rows, ingest.dealt
    ingest.only_rows = lambda *a: seen.append(only(*a)) or seen[-1]
    ingest.dealt = lambda *a: seen.append(dealt(*a)) or seen[-1]
    rows = [("a", "x", "alpha betagamma"), ("a", "y", "one"), ("a", "z", "two"), ("b", "x", "alpha betagamma")]
    assert told(ingest.run(objects(spark, *rows))) == {("a", "indexed"): (3, 4), ("b", "indexed"): (1, 2)}
    assert held(store, "a") == [("x", "alpha beta"), ("x", "gamma"), ("y", "one"), ("z", "two")] and held(store, "b") == held(store, "a")[:2]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    assert len(plans) == 2 and (not limit or all("strategy=broadcast" in p for p in plans))
