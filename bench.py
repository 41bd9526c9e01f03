"""Times of the named queries: one JSON line.

`BENCH_SF_DIR` (default /root/testdata/sf0.1) names the tables, `BENCH_CPUS` (default 8) the local cores,
`BENCH_RUNS` (default 3) the timed runs after a warm-up, of which the median counts. Names as arguments pick queries,
`all` stands for every named query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from tests.session import session

from freshet.catalog import all_queries
from freshet.catalog.event_queries import plain_chunkers
from freshet.catalog.inputs import CONFIG, DOCS, table
from freshet.catalog.search_queries import _questions
from freshet.operators.cells import build, fit, knn_cells
from freshet.operators.embedding import HashedBagOfWords
from freshet.operators.search import knn_exact
from freshet.plans.ingest import Ingest
from freshet.sources.shared import shared_dir
from freshet.sources.tables import TableStore

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "object_refs_from_events", "latest_event_per_key", "chunk_window", "chunk_markdown", "chunk_all_types", "chunk_paged",
    "chunk_rows", "transcript_chunks", "html_blocks", "json_objects", "ingest_plan", "knowledge_apply",
    "backfill_reembed", "hash_embed", "knn_exact", "knn_sketch", "rerank_topk", "answer_rows", "readings_tumbling",
    "stream_ingest",
)
# Queries that write tables are timed once.
HEAVY = {"stream_ingest", "stream_latest_per_key", "ingest_end_to_end"}


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def query_times(spark, wanted: list[str]) -> dict[str, float]:
    times = {}
    for name, query in all_queries().items():
        if wanted != ["all"] and name not in (wanted or HEADLINE):
            continue

        def run(query=query):
            consume(query.run(spark, SF_DIR))
            spark.catalog.clearCache()

        run()
        times[name] = round(statistics.median(timed(run) for _ in range(1 if name in HEAVY else RUNS)), 3)
    return times


def ingest_times(spark) -> dict[str, float]:
    """The ratio that matters: an ingest of nothing new against the first load."""
    store = TableStore(spark, shared_dir(spark, "bench"))
    ingest = Ingest(store, HashedBagOfWords(CONFIG.model, CONFIG.dim), plain_chunkers())
    objects = DOCS.spark(spark, SF_DIR).select("n", "bucket", "key", "content_type", "body")
    one_percent = objects.selectExpr(
        "bucket", "key", "content_type", "case when n%100=0 then body||' changed' else body end as body"
    )
    objects = objects.drop("n")
    times = {}
    for name, docs in (("first_load", objects), ("one_percent_changed", one_percent), ("nothing_changed", one_percent)):
        times[f"ingest_{name}"] = round(timed(lambda: ingest.run(docs).count()), 3)
    return times


def search_times(spark, k: int = 5) -> tuple[dict[str, float], float]:
    """An inverted file, fitted and written once, against the exact search, and the share of true neighbours it finds
    with all vectors as questions."""
    vectors = table(spark, SF_DIR, "embeddings")
    path = shared_dir(spark, "bench-cells")
    times = {"cells_built": round(timed(lambda: build(vectors, fit(vectors, 64, id_column="vec_id"), path, "vec_id")), 3)}

    def near(asked):
        return knn_cells(spark, path, asked, k, id_type="bigint", id_column="vec_id")

    few = _questions(vectors)
    times["cells_searched"] = round(statistics.median(timed(lambda: consume(near(few))) for _ in range(RUNS)), 3)
    every = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    exact = knn_exact(vectors, every, k, dim=64, id_column="vec_id").select("query_id", "vec_id")
    found = near(every).select("query_id", "vec_id").join(exact, ["query_id", "vec_id"], "left_semi").count()
    return times, round(found / exact.count(), 4)


def main() -> None:
    wanted = sys.argv[1:]
    spark = session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "16g"))
    times = query_times(spark, wanted)
    extra = {}
    if wanted in ([], ["all"]):
        times.update(ingest_times(spark))
        searched, extra["recall_at_5"] = search_times(spark)
        times.update(searched)
    print(
        json.dumps(
            {
                "metric": "total seconds of the timed queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cores": spark.sparkContext.defaultParallelism,
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
