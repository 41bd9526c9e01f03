"""The pipeline's stages one by one, each against what it must keep, and the named queries against their SQL."""

from __future__ import annotations

import pytest

import corpus_pipeline
from freshet.llm import decontamination
from freshet.llm.queries import QUERIES
from tests.compare import compare, connect
from tests.llm.test_operators import DOCS, brute_components, odd_rows, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_against_sql(spark, con, name):
    query = QUERIES[name]
    ours, theirs, *_ = compare(spark, con, query.run, query.sql, SF)
    assert ours == theirs and ours[1] > 0


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def stage(name: str):
    return next(f for n, f in corpus_pipeline.STAGES if n == name)


def test_stages_on_the_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {r.doc_id: r for r in docs.collect()}
    left = docs
    for n, (name, run) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in left.select("doc_id").collect()}
        run(spark, left, SF).write.parquet(str(tmp_path / str(n)))
        left = spark.read.parquet(str(tmp_path / str(n)))
        after = [r.doc_id for r in left.select("doc_id").collect()]
        assert set(after) <= before
        if n < 4:
            assert left.columns == columns
        if name == "quality classifier":
            quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [i for i in before if quality.get(i) == 1]
            assert sum(i in set(after) for i in good) >= 0.95 * len(good)
        elif name == "MinHash near-dedup":
            groups = brute_components([(i, seen[i].text) for i in before], 5, 80)
            assert sorted(after) == sorted(set(groups.values()))
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            dirty = {i for i in before if any(decontamination.normalized(t) in decontamination.normalized(seen[i].text) for _, t in items)}
            assert dirty.isdisjoint(after) and len(before - set(after)) <= len(dirty) + 2
        elif name == "mixing sources to target weights":
            assert max(after.count(i) for i in set(after)) <= 2
        else:
            for shard in left.toPandas().groupby("shard"):
                assert sorted(shard[1].slot) == list(range(len(shard[1])))


CLASHES = ("score", "held_out", "predicted", "n_shingles", "component_id", "kept", "leaks", "_times", "_epoch", "_row", "taken", "_key", "shard", "a b.c")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, name):
    """Every row comes out as it went in, whatever its further columns are called; ids may have several texts."""
    extra = [(*r, *(f"{c}{n}" for c in CLASHES)) for n, r in enumerate([*odd_rows(), (6, prose(60, 99), "de", "b", 3), (9, prose(60, 99), "de", "b", 3)])]
    docs = spark.createDataFrame(extra, DOCS + "".join(f", `{c}` string" for c in CLASHES))
    out = stage(name)(spark, docs, SF)
    if name != "sharding":
        assert out.dtypes == docs.dtypes
        assert {tuple(r) for r in out.collect()} <= set(extra)
    assert out.count() >= 0
    if name == "MinHash near-dedup":
        # The second text of 6 is a document of its own, in one group with 9; which of the two texts keeps the id is open.
        kept = [(r.doc_id, r.text) for r in out.collect()]
        assert sum(i == 6 and t == prose(60, 3) for i, t in kept) + sum(i == 7 for i, _ in kept) == 1
        assert sum(t == prose(60, 99) for _, t in kept) == 1
        assert [i for i, _ in kept].count(None) == 2 and {1, 2, 3, 4, 5, 8} <= {i for i, _ in kept}
    assert stage(name)(spark, docs.where("false"), SF).count() == 0


def test_dedup_of_repeated_ids_against_plain_grouping(spark):
    """Ids with several texts join no groups that have no link of their own."""
    texts = [prose(50, s) for s in range(12)]
    near = [t + " tail" for t in texts]
    table = [(n % 7, t) for n, t in enumerate(texts + near)] + [(100 + n, t) for n, t in enumerate(near[:5])] + [(3, texts[3])] * 4
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in table], DOCS).repartition(3)
    kept = [r.text for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()]
    assert sorted(t.removesuffix(" tail") for t in kept) == sorted(texts)
