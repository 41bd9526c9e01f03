import re
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.catalog.inputs import table
from freshet.operators import answers as an
from freshet.operators.cells import build, fit, is_built, knn_cells, load
from freshet.operators.embedding import HashedBagOfWords, words_of
from freshet.operators.rerank import attach_results, rerank, word_overlap
from freshet.operators.search import knn_approximate, knn_exact

SF = "/root/testdata/sf0.001"


def brute_force(vectors, asked, k):
    """Sorted by similarity, equal ones by id."""
    ids = [r["vec_id"] for r in vectors]
    m = np.array([r["embedding"] for r in vectors], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    found = {}
    for q in asked:
        v = np.array(q["embedding"], dtype=np.float64)
        scores = (m @ (v / np.linalg.norm(v)) + 1) / 2
        found[q["query_id"]] = sorted(ids, key=lambda i: (-round(scores[ids.index(i)], 9), i))[:k]
    return found


def grouped(hits):
    found = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    return found


@pytest.fixture(scope="module")
def vectors(spark):
    return table(spark, SF, "embeddings").persist()


def test_words_are_runs_of_ascii_letters(spark):
    texts = ["Ab-c", None, "", "\u00e9x\u6c49Yz", "1 2", "zz"] * 3 + ["tail"]
    array = pa.array(["skipped", *texts]).slice(1)
    row, words = words_of(array)
    plain = [(i, w) for i, t in enumerate(texts) for w in re.findall("[a-z]+", (t or "").lower())]
    assert list(zip(row.tolist(), words.to_pylist(), strict=True)) == plain
    blank = spark.createDataFrame([("1 2",), (None,), ("",)], "t string").select(HashedBagOfWords(dim=4).embed(F.col("t")).alias("v"))
    assert [list(r.v) for r in blank.collect()] == [[0.0] * 4] * 3


@pytest.mark.parametrize("block", [None, 60])
def test_exact_search_of_a_table_with_itself(spark, vectors, block):
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    hits = knn_exact(vectors, asked, 7, dim=64, id_column="vec_id", block=block)
    assert grouped(hits) == brute_force(vectors.collect(), asked.collect(), 7)


def test_copies_are_ordered_by_id(spark):
    """A third of all rows are copies of one vector, over several partitions."""
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else [0.6, 0.8 + i / 1e6]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(7)
    asked = spark.createDataFrame([("q", [2.0, 0.0]), ("zero", [0.0, 0.0])], "query_id STRING, embedding ARRAY<FLOAT>")
    found = grouped(knn_exact(df, asked, 5, dim=2, id_column="vec_id"))
    assert found == {"q": [0, 3, 6, 9, 12], "zero": [0, 1, 2, 3, 4]}


def test_other_dimensions_and_no_questions(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None)], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    asked = df.select(F.col("vec_id").alias("query_id"), "embedding")
    assert grouped(knn_exact(df, asked, 5, dim=2, id_column="vec_id")) == {1: [1]}
    assert knn_exact(df, asked.where("false"), 5, dim=2, id_column="vec_id").count() == 0


def test_sketches_find_most_of_the_nearest(spark, vectors):
    asked = vectors.where("vec_id < 40").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = grouped(knn_exact(vectors, asked, 5, dim=64, id_column="vec_id"))
    near = grouped(knn_approximate(vectors, asked, 5, dim=64, id_column="vec_id"))
    assert np.mean([len(set(exact[q]) & set(near[q])) / 5 for q in exact]) > 0.9
    everything = knn_approximate(vectors, asked, 5, dim=64, id_column="vec_id", candidates=10_000)
    assert grouped(everything) == exact


def recall_of(near, exact):
    return np.mean([len(set(exact[q]) & set(near.get(q, []))) / len(exact[q]) for q in exact])


def test_cells_find_nearly_all_of_the_nearest(spark, vectors, tmp_path):
    """All vectors as questions; the number of cells is the one measured when they were fitted."""
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    exact = grouped(knn_exact(vectors, asked, 5, dim=64, id_column="vec_id"))
    fitted = fit(vectors, 64, id_column="vec_id")
    assert len(fitted.centroids) == 23 and fitted.probes < 23
    path = str(tmp_path / "cells")
    build(vectors, fitted, path, "vec_id")
    assert is_built(spark, path) and not is_built(spark, path + "-other")
    stored = load(spark, path)
    assert np.array_equal(stored.centroids, fitted.centroids) and stored.probes == fitted.probes
    ask = partial(knn_cells, spark, path, asked, 5, id_type="bigint", id_column="vec_id")
    assert recall_of(grouped(ask()), exact) >= 0.95
    assert grouped(ask(probes=23)) == exact == grouped(ask(probes=23, block=90))


def test_cells_of_grouped_vectors_are_few_and_pruned(spark, tmp_path):
    """Well separated groups, one of them a third of all rows: few cells are looked at and only their folders read."""
    rng = np.random.default_rng(3)
    middles = rng.standard_normal((30, 16))
    rows = [(i, (middles[0 if i % 3 == 0 else i % 30] + 0.05 * rng.standard_normal(16)).tolist()) for i in range(1200)]
    rows += [(2000, None), (2001, [1.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(5)
    asked = df.where("vec_id % 50 = 1").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = grouped(knn_exact(df, asked, 5, dim=16, id_column="vec_id"))
    fitted = fit(df, 16, id_column="vec_id")
    assert fitted.probes < len(fitted.centroids) / 2
    path = str(tmp_path / "cells")
    build(df, fitted, path, "vec_id")
    one = asked.where("query_id = 1")
    near = knn_cells(spark, path, one, 5, id_type="bigint", id_column="vec_id")
    assert grouped(near) == {1: exact[1]}
    assert recall_of(grouped(knn_cells(spark, path, asked, 5, id_type="bigint", id_column="vec_id")), exact) >= 0.95
    plan = near._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.read.parquet(f"{path}/vectors").count() == 1200


def test_cells_looked_at_and_searched_equal_brute_force():
    """On few different values, so that many scores are ties."""
    from freshet.operators import cells, search

    rng = np.random.default_rng(5)
    draw = lambda n: search.unit_rows(rng.integers(-2, 3, (n, 5)).astype(float))
    fitted, asked = cells.Cells(draw(30), 11), draw(2100)
    looked = fitted.looked_at(asked)
    assert [np.flatnonzero(c).tolist() for c in looked.T] == np.sort(fitted.probed(asked), axis=1).tolist()
    vectors, ids = draw(900).astype(np.float32), rng.permutation(900)
    best, which = search._Best(2100, 4), np.arange(1, 2100, 7)
    for low, high in ((0, 3), (3, 500), (500, 900)):
        column = pa.array(vectors[low:high].tolist(), pa.list_(pa.float32()))
        best.search_some(pa.array(ids[low:high]), column, asked, which, asked.astype(np.float32))
    scores = np.round((search.unit_rows(vectors.astype(float)) @ asked.T + 1) / 2, 9)
    for q in range(2100):
        want = sorted(zip(-scores[:, q], ids.tolist()))[:4] if q in which else []
        assert [i for _, i, _ in best.kept[q]] == [i for _, i in want]
        assert np.allclose([s for *_, s in best.kept[q]], [-t for t, _ in want], atol=1e-9)


def test_scans_of_several_blocks_share_the_tasks(spark, vectors):
    """What is shuffled grows with the questions and the cores, not with the blocks of questions as well."""
    from freshet.operators import search

    rows = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).repartition(64)
    asked = rows.select(F.col("id").alias("query_id"), "v")
    scan = partial(search._whole, score=search._cosine_scores)
    found, real = [], search._scanned
    search._scanned = lambda *args: found.append(real(*args)) or found[-1]
    try:
        search.best_k(asked, 3, rows.schema["id"], 64, 100, lambda _: (rows, scan))
    finally:
        search._scanned = real
    assert len(found) > 4 and sum(f.rdd.getNumPartitions() for f in found) < search.scan_tasks(spark) + len(found)


def test_cells_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "chunk_id STRING, embedding ARRAY<FLOAT>")
    build(none, fit(none, 4), str(tmp_path / "c"))
    asked = spark.createDataFrame([("q", [1.0, 0.0, 0.0, 0.0])], "query_id STRING, embedding ARRAY<FLOAT>")
    assert knn_cells(spark, str(tmp_path / "c"), asked).count() == 0


def test_scan_passes_on_one_best_k_per_task(spark, vectors):
    """However many splits there are, what is shuffled is bounded by tasks x questions x k."""
    from freshet.operators import search

    many = vectors.repartition(200).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    asked = vectors.where("vec_id < 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("v"))
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.DoubleType())])
    score, prepare = search._KINDS["cosine"]
    hits = search._scanned(many, asked.toArrow(), 2, schema, partial(search._whole, score=score), prepare)
    assert hits.count() <= search.scan_tasks(spark) * 3 * 2 < 200 * 3 * 2


def test_stand_in_embedder(spark):
    df = spark.createDataFrame([(1, "Some words, some WORDS"), (2, ""), (3, None), (4, "words words some some"), (5, "éà")], "i INT, t STRING")
    got = {r["i"]: r for r in df.select("i", HashedBagOfWords("m", 32).embed(F.col("t")).alias("v"), HashedBagOfWords("n", 32).embed(F.col("t")).alias("w")).collect()}
    assert got[1]["v"] == got[4]["v"] and got[1]["v"] != got[1]["w"]
    assert abs(sum(x * x for x in got[1]["v"]) - 1) < 1e-6 and all(len(r["v"]) == 32 for r in got.values())
    assert not any(got[2]["v"]) and not any(got[3]["v"]) and not any(got[5]["v"])


HITS = [("q", "red green", 1, "c1", 0.9, "red only"), ("q", "red green", 2, "c2", 0.8, "green and RED"), ("q", "red green", 3, "c3", 0.7, "blue"), ("p", "x", 1, "c9", 0.5, "x")]
HIT_DDL = "query_id STRING, query STRING, rank INT, chunk_id STRING, score DOUBLE, text STRING"


def test_rerank_and_fallbacks(spark):
    hits = spark.createDataFrame(HITS, HIT_DDL)

    def order(df):
        return [(r["query_id"], r["chunk_id"], r["rerank_score"]) for r in df.orderBy("query_id", "rank").collect()]

    assert order(rerank(hits, word_overlap, 2)) == [("p", "c9", 1.0), ("q", "c2", 1.0), ("q", "c1", 0.5)]
    assert order(rerank(hits, None, 2)) == [("p", "c9", None), ("q", "c1", None), ("q", "c2", None)]

    def failing_on_blue(query, text):
        return F.when(text != "blue", word_overlap(query, text))

    assert order(rerank(hits, failing_on_blue, 2)) == [("p", "c9", 1.0), ("q", "c1", None), ("q", "c2", None)]
    assert rerank(hits.where("false"), word_overlap, 2).count() == 0
    results = spark.createDataFrame([("q", 2, 0.75)], "query_id STRING, index INT, relevance DOUBLE")
    assert [(r["chunk_id"], r["rerank_score"]) for r in attach_results(hits, results).collect()] == [("c3", 0.75)]


def test_answers_and_references(spark):
    hits = spark.createDataFrame(HITS, HIT_DDL).withColumn("source_uri", F.concat(F.lit("s3://b/"), "chunk_id"))
    ranked = rerank(hits, word_overlap, 2)
    asked = spark.createDataFrame([("q", "red green"), ("p", "x"), ("none", "y")], "query_id STRING, query STRING")

    def echo(prompt):
        return F.when(prompt.contains("red green"), F.concat(F.lit("[2] "), F.substring(prompt, 1, 8)))

    rows = {r["query_id"]: r for r in an.answer_rows(asked, ranked, "knowledge", "m", echo).collect()}
    assert rows["q"]["answer"] == "[2] Question" and rows["q"]["answer_available"]
    assert [(s["n"], s["chunk_id"], s["score"], s["vector_score"]) for s in rows["q"]["sources"]] == [(1, "c2", 1.0, 0.8), (2, "c1", 0.5, 0.9)]
    assert rows["p"]["answer"] is None and not rows["p"]["answer_available"] and rows["none"]["sources"] == []
    prompt = an.context_blocks(ranked).where("query_id = 'q'").first()["context"]
    assert prompt == "[1] (source: s3://b/c2)\ngreen and RED\n\n[2] (source: s3://b/c1)\nred only"
    answers = an.answer_rows(asked, ranked, "knowledge", "m", echo)
    links = {r["query_id"]: (r["n"], r["label"], r["href"]) for r in an.primary_reference(answers, ["query_id"]).collect()}
    assert links == {"q": (2, "c1", None), "p": (1, "c9", None)}
    unknown = answers.withColumn("answer", F.lit("see [7]"))
    assert {r["n"] for r in an.primary_reference(unknown, ["query_id"]).collect()} == {1}


def test_many_questions_do_not_pass_the_driver(spark, vectors, monkeypatch):
    """More questions than one block are searched on a grid of several parts and stripes."""
    from pyspark.sql import DataFrame

    from freshet.operators import search

    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    wanted = brute_force(vectors.collect(), asked.collect(), 5)
    monkeypatch.setattr(search, "BROADCAST_QUESTIONS", 60)
    monkeypatch.setattr(DataFrame, "toArrow", lambda _: pytest.fail("questions came to the driver"))
    hits = knn_exact(vectors, asked, 5, dim=64, id_column="vec_id")
    assert grouped(hits) == wanted


def test_memory_of_a_search_task_is_bounded():
    """Few chunks' scores, and few texts' words, are held at a time, however large a batch is."""
    import tracemalloc

    import pyarrow as pa

    from freshet.operators import search

    rng = np.random.default_rng(0)
    asked = search.unit_rows(rng.normal(size=(1000, 8)))
    chunks = pa.ListArray.from_arrays(pa.array(np.arange(10_001, dtype=np.int32) * 8), pa.array(rng.normal(size=80_000)))
    best = search._Best(1000, 3)
    tracemalloc.start()
    best.search(search._cosine_scores, pa.array(range(10_000)), chunks, asked)
    assert tracemalloc.get_traced_memory()[1] < 40_000_000
    tracemalloc.stop()
    assert {len(kept) for kept in best.kept} == {3}
