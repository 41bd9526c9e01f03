"""From ranked hits to prompts, answer rows, memory rows and citations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import text as tx
from freshet.functions.arrays import let
from freshet.schemas import SOURCE_DDL

# Prompt to answer; NULL when there is no model or the call failed.
Answerer = Callable[[Column], Column]

# Characters of a source shown in an answer row and in a console line.
SOURCE_CHARS, SNIPPET_CHARS = 600, 160

# The prompt, a source block in it, and what stands between blocks.
PROMPT = "Question: %s\n\nSources:\n%s"
SOURCE_BLOCK = "[%d] (source: %s)\n%s"
BLOCK_GAP = "\n\n"


def _context() -> Column:
    """The numbered source blocks of a group of hits, in rank order. A question has at most top_k hits."""
    block = F.format_string(SOURCE_BLOCK, F.col("rank"), F.col("source_uri"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    return F.array_join(F.transform(ordered, lambda s: s["block"]), BLOCK_GAP)


def context_blocks(ranked: DataFrame) -> DataFrame:
    """One context text per question."""
    return ranked.groupBy("query_id", "query").agg(_context().alias("context"))


def prompt(query: Column, context: Column) -> Column:
    return F.format_string(PROMPT, query, context)


def sources_column(ranked: DataFrame, *more: Column) -> DataFrame:
    """The source list of each question, as answer rows carry it, and `more` aggregates of the same hits."""
    vector = F.coalesce(F.col("score"), F.lit(0.0))
    source = F.struct(
        F.col("rank").cast("int").alias("n"),
        F.col("source_uri").alias("s3_uri"),
        F.col("chunk_id"),
        tx.round4(F.coalesce(F.col("rerank_score"), vector)).alias("score"),
        tx.round4(vector).alias("vector_score"),
        F.substring("text", 1, SOURCE_CHARS).alias("text"),
    )
    return ranked.groupBy("query_id").agg(F.array_sort(F.collect_list(source)).alias("sources"), *more)


def answer_rows(
    questions: DataFrame, ranked: DataFrame, active_collection: str, model: str, answerer: Answerer | None = None
) -> DataFrame:
    """One answer row per question (query_id, query), also for questions without a hit.

    Sources and prompt come from one aggregation, so the search below runs once and both show the same hits.
    """
    asked = questions.select("query_id", "query")
    more = [] if answerer is None else [_context().alias("context")]
    with_sources = asked.join(sources_column(ranked, *more), "query_id", "left").withColumn(
        "sources", F.coalesce("sources", F.array().cast(f"array<{SOURCE_DDL}>"))
    )
    if answerer is None:
        answered = with_sources.withColumn("answer", F.lit(None).cast("string"))
    else:
        full = prompt(F.col("query"), F.coalesce(F.col("context"), F.lit("")))
        answered = with_sources.withColumn("answer", answerer(full))
    return answered.select(
        "query_id",
        "query",
        "answer",
        F.col("answer").isNotNull().alias("answer_available"),
        F.lit(active_collection).alias("active_collection"),
        F.lit(model).alias("model"),
        "sources",
    )


def flat_sources(answers: DataFrame) -> DataFrame:
    return answers.select("query_id", "query", "answer_available", F.explode("sources").alias("s")).select(
        "query_id", "query", "answer_available", "s.*"
    )


def snippet(text: Column) -> Column:
    return F.replace(F.substring(text, 1, SNIPPET_CHARS), F.lit("\n"), F.lit(" "))


def hit_lines(hits: DataFrame) -> DataFrame:
    """Hits as they are listed on a console."""
    return hits.select(
        "query_id", "rank", F.round("score", 4).alias("score"), "source_uri", "chunk_id",
        snippet(F.col("text")).alias("snippet"),
    )


def memory_rows(answers: DataFrame, answer_model: str, ts: Column | None = None) -> DataFrame:
    return answers.select(
        "query",
        "answer",
        F.transform("sources", lambda s: s["chunk_id"]).alias("sources"),
        F.lit(answer_model).alias("model"),
        (F.current_timestamp() if ts is None else ts).alias("ts"),
    )


def recent_memory(memory: DataFrame, n: int) -> DataFrame:
    return memory.orderBy(F.desc("ts"), "query").limit(n)


def citations(answers: DataFrame, kept: list[str], answer: str = "answer") -> DataFrame:
    """One row per cited number, with its first-seen position."""
    numbers = tx.citation_numbers(F.col(answer))
    return answers.select(*kept, F.posexplode(numbers).alias("position", "n"))


def primary_reference(answers: DataFrame, kept: list[str]) -> DataFrame:
    """Label and link of the source an answer leans on: the first cited one that exists, else the first source.

    The sources travel inside the answer row, so this needs no join.
    """
    sources = F.col("sources")

    def first_cited(numbers: Column) -> Column:
        listed = F.transform(numbers, lambda n: F.get(F.filter(sources, lambda s: s["n"] == n), F.lit(0)))
        return F.get(F.filter(listed, lambda s: s.isNotNull()), F.lit(0))

    chosen = F.coalesce(let(tx.citation_numbers(F.col("answer")), first_cited), F.get(sources, F.lit(0)))
    uri, text = F.col("_s.s3_uri"), F.col("_s.text")
    is_link = uri.startswith("http://") | uri.startswith("https://")
    return (
        answers.withColumn("_s", chosen)
        .where(F.col("_s").isNotNull())
        .select(
            *kept,
            F.col("_s.n").alias("n"),
            tx.basename(uri).alias("label"),
            F.when(is_link, uri).otherwise(tx.first_http_url(text)).alias("href"),
        )
    )
