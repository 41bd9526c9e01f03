"""Embedding, vector search, reranking, answers and citations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog.chunk_queries import PLAIN_CHUNKS_SQL, plain_chunks
from freshet.catalog.inputs import ANSWERS, CONFIG, DIM, embedding_sql, table
from freshet.catalog.registry import Query
from freshet.config import BLUE
from freshet.operators import answers as an
from freshet.operators import extras
from freshet.operators.cells import CENTROID_PLACES, ROUNDS, build, fit, knn_cells
from freshet.operators.embedding import HashedBagOfWords
from freshet.operators.rerank import rerank, word_overlap
from freshet.operators.search import candidates_for, knn_approximate, knn_exact
from freshet.plans.ask import retrieve
from freshet.sources.shared import shared_dir

EMBEDDER = HashedBagOfWords(CONFIG.model, DIM)


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-zero vector entries of every chunk."""
    vectors = plain_chunks(spark, sf_dir).select("chunk_id", EMBEDDER.embed(F.col("text")).alias("e"))
    return (
        vectors.select("chunk_id", F.posexplode("e").alias("b", "v"))
        .where(F.col("v") != 0)
        .select("chunk_id", "b", F.round(F.col("v").cast("double"), 6).alias("v"))
    )


# ---- the test vectors: one question per label, the label's first vector ---------------------------------------------

def _questions(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def knn_exact_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return _rounded(knn_exact(vectors, _questions(vectors), 5, dim=64, id_column="vec_id"))


def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    allowed = F.col("label").isin(1, 4, 7)
    return _rounded(knn_exact(vectors, _questions(vectors), 5, dim=64, id_column="vec_id", where=allowed))


def knn_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search the way it runs for question tables that are too large to broadcast: on a grid."""
    vectors = table(spark, sf_dir, "embeddings")
    return _rounded(knn_exact(vectors, _questions(vectors), 5, dim=64, id_column="vec_id", block=4))


def knn_many_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as questions, more than one block holds."""
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return _rounded(knn_exact(vectors, asked, 5, dim=64, id_column="vec_id", block=200))


def knn_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return _rounded(knn_approximate(vectors, _questions(vectors), 5, dim=64, id_column="vec_id"))


def knn_cells_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as questions to an inverted file, each looking at three quarters of the cells."""
    vectors = table(spark, sf_dir, "embeddings")
    cells = fit(vectors, 64, id_column="vec_id")
    cells = replace(cells, probes=-(-3 * len(cells.centroids) // 4))
    path = shared_dir(spark, "cells")
    build(vectors, cells, path, "vec_id")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return _rounded(knn_cells(spark, path, asked, 5, id_type="bigint", id_column="vec_id"))


_PER_LABEL = "select label as query_id, arg_min({vector}, vec_id) as v from embeddings group by 1"


def _knn_sql(where: str = "true", vector: str = "embedding", k: int = 5, asked: str = _PER_LABEL) -> str:
    return f"""
    select query_id, vec_id, round(s, 6) as score, rank from (
      select query_id, vec_id, s, cast(row_number() over (partition by query_id order by round(s, 9) desc, vec_id) as int) as rank
      from (select q.query_id, e.vec_id,
            (1 + list_cosine_similarity(cast(e.{vector} as double[]), cast(q.v as double[]))) / 2 as s
            from embeddings e, ({asked.format(vector=vector)}) q
            where {where}))
    where rank <= {k}
    """


def _sketch_sql(k: int = 5, bits: int = 256, dim: int = 64) -> str:
    """The candidates with most signs in common, scored exactly."""
    return f"""
    with e as (select vec_id, label, cast(embedding as double[]) as v from embeddings where len(embedding) = {dim}),
    q as (select label as query_id, arg_min(v, vec_id) as v from e group by 1),
    p as (select b, list(case when md5(b::varchar||':'||d::varchar) < '8' then 1.0::double else -1.0::double end order by d) as s
      from range({bits}) t(b), range({dim}) u(d) group by b),
    se as (select vec_id, b, list_dot_product(v, s) > 0 as bit from e, p),
    sq as (select query_id, b, list_dot_product(v, s) > 0 as bit from q, p),
    f as (select query_id, vec_id, count(*) filter (se.bit = sq.bit) as same from se join sq using (b) group by query_id, vec_id),
    c as (select query_id, vec_id from (select *, row_number() over (partition by query_id order by same desc, vec_id) as n
      from f) where n <= {candidates_for(k)})
    select query_id, vec_id, round(s, 6) as score, rank from (
      select query_id, vec_id, s, cast(row_number() over (partition by query_id order by round(s, 9) desc, vec_id) as int) as rank
      from (select query_id, vec_id, (1 + list_cosine_similarity(e.v, q.v)) / 2 as s
            from c join e using (vec_id) join q using (query_id)))
    where rank <= {k}
    """


def _cells_sql(k: int = 5, dim: int = 64) -> str:
    """Centroids by two rounds of means, each vector in its nearest cell, each question in three quarters of the cells."""
    near = "row_number() over (partition by u.vec_id order by round(list_dot_product(u.v, c.v), 9) desc, cell)"
    unit = "list_transform({v}, lambda x: x / sqrt(list_dot_product({v}, {v})))"
    ctes = [
        f"e as (select vec_id, cast(embedding as double[]) as v from embeddings where len(embedding) = {dim})",
        f"u as (select vec_id, {unit.format(v='v')} as v from e)",
        "o as (select *, row_number() over (order by md5(vec_id::varchar), vec_id::varchar) - 1 as cell from u)",
        f"c0 as (select cell, list_transform(v, lambda x: round(x, {CENTROID_PLACES})) as v from o "
        "where cell < (select ceil(sqrt(count(*))) from e))",
    ]
    for n in range(ROUNDS):
        ctes += [
            f"a{n} as (select vec_id, cell from (select u.vec_id, cell, {near} as n from u, c{n} c) where n = 1)",
            f"m{n} as (select cell, list(s order by j) as v from (select cell, j, sum(x) as s from (select cell, unnest(v) as x, "
            f"generate_subscripts(v, 1) as j from a{n} join u using (vec_id)) group by all) group by cell)",
            f"c{n + 1} as (select cell, list_transform(coalesce({unit.format(v='m.v')}, c.v), lambda x: round(x, "
            f"{CENTROID_PLACES})) as v from c{n} c left join m{n} m using (cell))",
        ]
    return f"""
    with {', '.join(ctes)},
    places as materialized (select u.vec_id, cell, {near} as n from u, c{ROUNDS} c),
    looked as (select vec_id as query_id, cell from places where n <= (select ceil(3 * count(*) / 4) from c0)),
    homes as (select vec_id, cell from places where n = 1)
    select query_id, vec_id, round(s, 6) as score, rank from (
      select query_id, vec_id, s, cast(row_number() over (partition by query_id order by round(s, 9) desc, vec_id) as int) as rank
      from (select query_id, homes.vec_id, (1 + list_cosine_similarity(e.v, q.v)) / 2 as s
            from looked join homes using (cell) join e on e.vec_id = homes.vec_id join e q on q.vec_id = query_id))
    where rank <= {k}
    """


def ab_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models compared: the full vectors against their first half."""
    full = table(spark, sf_dir, "embeddings")
    half = full.withColumn("embedding", F.slice("embedding", 1, 32))
    a = knn_exact(full, _questions(full), 10, dim=64, id_column="vec_id")
    b = knn_exact(half, _questions(half), 10, dim=32, id_column="vec_id")
    return extras.overlap_at_k(a, b, 10, "vec_id")


_HALF = "embeddings as (select vec_id, label, list_slice(embedding, 1, 32) as embedding from main.embeddings)"
_AB_SQL = f"""
with a as ({_knn_sql(k=10)}), b as (with {_HALF} {_knn_sql(k=10)}),
j as (select query_id, a.vec_id as x, b.vec_id as y from a full outer join b using (query_id, vec_id))
select query_id, cast(count(*) filter (x is not null and y is not null) as int) as common,
 count(*) filter (x is not null and y is not null) / 10.0 as overlap from j group by query_id
"""


# ---- questions against document chunks ------------------------------------------------------------------------------

def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query")
    )


def hits(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    asked = questions(spark, sf_dir)
    corpus = plain_chunks(spark, sf_dir).withColumn("embedding", EMBEDDER.embed(F.col("text")))
    return retrieve(corpus, asked, EMBEDDER, k).join(asked, "query_id")


_HITS_CTE = f"""
c as materialized ({PLAIN_CHUNKS_SQL}),
cv as materialized ({embedding_sql('c', 'chunk_id', CONFIG.model)}),
q as (select cast(item_id as varchar) as query_id, text as query from benchmark),
qt as (select query_id, query as text from q),
qv as materialized ({embedding_sql('qt', 'query_id', CONFIG.model)}),
cn as (select chunk_id, sqrt(sum(v::double*v::double)) as n from cv group by 1),
qn as (select query_id, sqrt(sum(v::double*v::double)) as n from qv group by 1),
d as (select query_id, chunk_id, sum(cv.v::double*qv.v::double) as dot from cv join qv using (b) group by all),
s as (select q.query_id, c.chunk_id, (1 + coalesce(dot / (cn.n * qn.n), 0)) / 2 as score
      from q cross join c left join d on d.query_id = q.query_id and d.chunk_id = c.chunk_id
      left join cn on cn.chunk_id = c.chunk_id left join qn on qn.query_id = q.query_id),
hits as materialized (select * from (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, chunk_id)
      as int) as rank from s) where rank <= 10),
words as (select query_id, rank, list_distinct(regexp_extract_all(lower_q, '[a-z]+')) as qw,
      list_distinct(regexp_extract_all(lower_t, '[a-z]+')) as tw
      from (select query_id, rank, translate(query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_q,
            translate(c.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_t
            from hits join q using (query_id) join c using (chunk_id))),
scored as (select query_id, rank, case when len(qw) = 0 then 0.0 else
      len(list_intersect(qw, tw)) / cast(len(qw) as double) end as rs from words),
ranked as (select * from (select h.query_id, h.chunk_id, h.score, rs as rerank_score,
      cast(row_number() over (partition by h.query_id order by rs desc, h.rank) as int) as rank
      from hits h join scored using (query_id, rank)) where rank <= 5)
"""


def vector_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hits(spark, sf_dir)).select("query_id", "rank", "score", "chunk_id", "source_uri", "ordinal")


def _reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank(hits(spark, sf_dir), word_overlap, CONFIG.top_k)


def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_reranked(spark, sf_dir)).select(
        "query_id", "rank", "chunk_id", "score", F.round("rerank_score", 6).alias("rerank_score")
    )


def rerank_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rerank(hits(spark, sf_dir), None, CONFIG.top_k)).select(
        "query_id", "rank", "chunk_id", "score", "rerank_score"
    )


def prompt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = an.context_blocks(_reranked(spark, sf_dir))
    return blocks.select("query_id", an.prompt(F.col("query"), F.col("context")).alias("prompt"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.answer_rows(questions(spark, sf_dir), _reranked(spark, sf_dir), BLUE, CONFIG.model)


def answer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.flat_sources(_answers(spark, sf_dir))


def hit_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.hit_lines(hits(spark, sf_dir))


# Memory rows get a time of their own question, so that both engines see the same one.
_ASKED_AT = "timestamp'2024-01-01 00:00:00'"


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.expr(f"{_ASKED_AT} + make_interval(0,0,0,0,0,cast(query_id as int))")
    return an.memory_rows(_answers(spark, sf_dir), CONFIG.answer_model, ts).withColumn(
        "sources", F.array_join("sources", ",")
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def memory_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memory(spark, sf_dir)


def memory_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.recent_memory(_memory(spark, sf_dir), 10)


_MEMORY_SQL = f"""
select any_value(q.query) as query, null::varchar as answer, string_agg(chunk_id, ',' order by rank) as sources,
 '{CONFIG.answer_model}' as model, timestamp '2024-01-01' + to_minutes(cast(q.query_id as bigint)) as ts
from q join ranked using (query_id) group by q.query_id
"""


# ---- citations ------------------------------------------------------------------------------------------------------

def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited numbers that name one of five sources."""
    cited = an.citations(ANSWERS.spark(spark, sf_dir), ["qid"])
    return cited.where(F.col("n") <= 5)


# Five sources per answer; the second is a link itself, the others mention one.
_SOURCE_URI = (
    "case %(n)s when 2 then 'https://example.org/'||lang||'/'||cast(qid as string) else "
    "'s3://'||source||'/'||lang||'/'||cast(qid as string)||'-'||'%(n)s'||'.md' end"
)
_SOURCE_TEXT = (
    "case %(n)s when 3 then 'no link' else 'See (https://example.org/d?id='||cast(qid as string)||'&n=%(n)s). '||text end"
)


def primary_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    def source(n: int):
        return F.struct(
            F.lit(n).alias("n"), F.expr(_SOURCE_URI % {"n": n}).alias("s3_uri"), F.expr(_SOURCE_TEXT % {"n": n}).alias("text")
        )

    answers = ANSWERS.spark(spark, sf_dir).withColumn("sources", F.array(*[source(n) for n in range(1, 6)]))
    return an.primary_reference(answers, ["qid"])


_CITED_CTE = f"""
a as ({ANSWERS.sql}),
m as (select qid, regexp_extract_all(answer, '\\[([0-9]+)\\]', 1) as l from a where answer is not null),
u as (select qid, cast(unnest(l) as int) as n, generate_subscripts(l, 1) as i from m),
f as (select qid, n, min(i) as i from u where n > 0 group by all),
cited as (select qid, n, cast(row_number() over (partition by qid order by i) - 1 as int) as position from f)
"""
_PRIMARY_SQL = f"""
with {_CITED_CTE},
src as ({' union all '.join(f"select qid, {n} as n, {_SOURCE_URI % {'n': n}} as uri, {_SOURCE_TEXT % {'n': n}} as text from a" for n in range(1, 6))}),
best as (select qid, arg_min(n, position) as n from cited where n <= 5 group by 1),
pick as (select src.* from src left join best using (qid) where src.n = coalesce(best.n, 1))
select qid, n, regexp_extract(uri, '[^/]*$') as label, case when starts_with(uri, 'http') then uri else
 nullif(regexp_replace(regexp_extract(text, '(?i)https?://[^\\s\\])>]+'), '[.,;:)]+$', ''), '') end as href from pick
"""

_ROUND4 = "case when {x}*32 = floor({x}*32) then cast(round_even({x}, 4) as double) else round({x}, 4) end"

QUERIES = {
    "hash_embed": Query(
        hash_embed,
        f"with c as ({PLAIN_CHUNKS_SQL}) select chunk_id, b, round(cast(v as double), 6) as v from "
        f"({embedding_sql('c', 'chunk_id', CONFIG.model)})",
    ),
    "knn_exact": Query(knn_exact_labels, _knn_sql()),
    "knn_filtered": Query(knn_filtered, _knn_sql("e.label in (1, 4, 7)")),
    "knn_grid": Query(knn_grid, _knn_sql()),
    "knn_many_questions": Query(
        knn_many_questions, _knn_sql(asked="select vec_id as query_id, embedding as v from embeddings")
    ),
    "knn_sketch": Query(knn_sketch, _sketch_sql()),
    "knn_cells": Query(knn_cells_all, _cells_sql()),
    "ab_overlap": Query(ab_overlap, _AB_SQL),
    "vector_hits": Query(
        vector_hits,
        f"with {_HITS_CTE} select query_id, rank, round(score, 6) as score, chunk_id, source_uri, ordinal "
        "from hits join c using (chunk_id)",
    ),
    "rerank_topk": Query(
        rerank_topk,
        f"with {_HITS_CTE} select query_id, rank, chunk_id, round(score, 6) as score, "
        "round(rerank_score, 6) as rerank_score from ranked",
    ),
    "rerank_fallback": Query(
        rerank_fallback,
        f"with {_HITS_CTE} select query_id, rank, chunk_id, round(score, 6) as score, null::double as rerank_score "
        "from hits where rank <= 5",
    ),
    "prompt_context": Query(
        prompt_context,
        f"with {_HITS_CTE} select query_id, 'Question: '||any_value(query)||chr(10)||chr(10)||'Sources:'||chr(10)||"
        "string_agg('['||cast(rank as varchar)||'] (source: '||source_uri||')'||chr(10)||text, chr(10)||chr(10) order by rank) "
        "as prompt from ranked join q using (query_id) join c using (chunk_id) group by query_id",
    ),
    "answer_rows": Query(
        answer_rows,
        f"with {_HITS_CTE} select query_id, query, false as answer_available, rank as n, source_uri as s3_uri, chunk_id, "
        f"{_ROUND4.format(x='rerank_score')} as score, {_ROUND4.format(x='score')} as vector_score, "
        "substring(text, 1, 600) as text from ranked join q using (query_id) join c using (chunk_id)",
    ),
    "hit_snippets": Query(
        hit_snippets,
        f"with {_HITS_CTE} select query_id, rank, round(score, 4) as score, source_uri, chunk_id, "
        "replace(substring(text, 1, 160), chr(10), ' ') as snippet from hits join c using (chunk_id)",
    ),
    "memory_append": Query(memory_append, f"with {_HITS_CTE} {_MEMORY_SQL}"),
    "memory_recent": Query(memory_recent, f"with {_HITS_CTE} {_MEMORY_SQL} order by ts desc limit 10"),
    "citations": Query(citations, f"with {_CITED_CTE} select qid, position, n from cited where n <= 5"),
    "primary_reference": Query(primary_reference, _PRIMARY_SQL),
}
