"""The corpus pipeline: documents that are good, single and clean, mixed and dealt into shards.

Each stage takes (spark, docs, sf_dir); what it returns is written and read again as the next one's docs. Every stage
works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontamination, mixing, near_dedup, quality, sharding
from freshet.llm.common import in_order, ranked, read, written


def _with_row(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that a stage looks at, and the whole row as one more, so that no column it adds meets one of these."""
    return docs.select(*needed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def _rows(found: DataFrame) -> DataFrame:
    return found.select("_row.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good.

    Rows are judged one by one, so repeated rows stay or go together, and so do rows without an id. A null or empty text
    is scored as one without words. Very long texts are judged whole. An empty table gives an empty table.
    """
    judged = quality.judged(_with_row(docs, "doc_id", "text", "n_chars"), read(spark, sf_dir, "labels"))
    return _rows(judged.where("predicted = 1"))


def _own_ids(docs: DataFrame) -> DataFrame:
    """doc_id, text and _row, with ids that name one text each: where an id has several texts, the first by hash keeps it
    and the others get ids that no row has. Only rows whose id occurs more than once are looked at."""
    slim = _with_row(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null")
    repeated = written(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return slim
    shared = slim.join(repeated, "doc_id", "left_semi").withColumn("_said", F.sha2(F.coalesce("text", F.lit("")), 256))
    said = shared.select("doc_id", "_said").distinct()
    ordered = in_order(said, [F.col("doc_id"), F.col("_said")], "said")
    ends = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    # Beyond all ids, on the side where there is room.
    new = F.lit(ends[1] + 1) + F.col("_id") if ends[1] < 1 << 61 else F.lit(ends[0] - 1) - F.col("_id")
    names = ranked(ordered, "doc_id", "_k").select("doc_id", "_said", F.when(F.col("_k") > 0, new).alias("_new"))
    renamed = shared.join(names, ["doc_id", "_said"]).select(F.coalesce("_new", "doc_id").alias("doc_id"), "text", "_row")
    return slim.join(repeated, "doc_id", "left_anti").select("doc_id", "text", "_row").unionByName(renamed)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows with the same id and text are one document, of which the smallest row stays. Different texts under one id are
    documents of their own: the second one's group is not that of the first. Rows without an id stay. A document without
    words is linked with nothing. Very long texts are compared whole. An empty table gives an empty table.
    """
    own = _own_ids(docs)
    kept = near_dedup.grouped(own, words=5, percent=80).where("kept").select("doc_id", "_row")
    repeated = written(
        own.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"),
        "repeated",
    )
    single = kept.join(repeated, "doc_id", "left_anti")
    first = kept.join(repeated, "doc_id").groupBy("doc_id").agg(F.min("_row").alias("_row"))
    return _rows(single.select("_row").unionByName(first.select("_row")))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows are judged one by one. A null or empty text holds nothing. Very long texts are searched whole. Without items all
    documents stay; an empty table gives an empty table.
    """
    found = decontamination.with_leaks(_with_row(docs, "text"), read(spark, sf_dir, "benchmark"))
    return _rows(found.where(F.size("leaks") == 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: once for each epoch in which it takes any of their words.

    Without an id or a word a document is no part of the schedule; it stays as it is. Rows that share an id are taken
    equally often, as often as the one that the mix takes most. An empty table gives an empty table.
    """
    times = mixing.mixed(docs).where("doc_id is not null and size > 0").groupBy("doc_id").agg(
        F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("_times")
    )
    joined = _with_row(docs, "doc_id").join(times, "doc_id", "left")
    often = F.coalesce("_times", F.lit(1))
    return _rows(joined.where(often > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(1), often))))


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's id, size, checksum, shard and place in it.

    A shard follows from the id alone: rows without an id go to one shard, rows that share an id together, and every
    epoch of a document to its shard. A null text has no bytes. An empty table gives an empty table.
    """
    return sharding.placed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mix_sources),
    ("sharding", deal_into_shards),
]

# A learned classifier, MinHash and edit distances cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
