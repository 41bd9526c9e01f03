"""Second ranking of the hits of each question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# (query, text) to a relevance score; a pandas or Arrow UDF around a hosted model fits as well. NULL means failed.
Scorer = Callable[[Column, Column], Column]


def _words(text: Column) -> Column:
    ascii_lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(ascii_lower, "[^a-z]+"), lambda w: w != ""))


def word_overlap(query: Column, text: Column) -> Column:
    """Share of the question's words that occur in the text. An offline stand-in for a cross-encoder."""
    asked = _words(query)
    return F.when(F.size(asked) > 0, F.size(F.array_intersect(asked, _words(text))) / F.size(asked)).otherwise(0.0)


def rerank(hits: DataFrame, scorer: Scorer | None, top_k: int = 5) -> DataFrame:
    """First `top_k` hits per question by the scorer, then by vector rank.

    Without a scorer, or when it failed on any hit of a question, the question keeps its vector order and gets no
    rerank score. Hits are (query_id, query, text, rank, ...); `rank` is replaced by the new one.
    """
    score = F.lit(None).cast("double") if scorer is None else scorer(F.col("query"), F.col("text")).cast("double")
    whole = Window.partitionBy("query_id")
    usable = F.when(~F.max(F.col("_s").isNull()).over(whole), F.col("_s"))
    order = whole.orderBy(F.desc_nulls_last("rerank_score"), "rank")
    return (
        hits.withColumn("_s", score)
        .withColumn("rerank_score", usable)
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= top_k)
        .drop("_s", "rank")
        .withColumnRenamed("_n", "rank")
    )


def attach_results(hits: DataFrame, results: DataFrame) -> DataFrame:
    """Hits picked by a hosted reranker's answer: (query_id, index, relevance), index from 0 in hit order."""
    wanted = results.select("query_id", (F.col("index") + 1).alias("rank"), F.col("relevance").alias("rerank_score"))
    return hits.join(wanted, ["query_id", "rank"])
