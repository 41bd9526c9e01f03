"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes (inserts, deletes, revised texts) is turned into counts, compared with what the ledger says about the
same documents, and added to the totals as differences: what a document counted so far with a minus sign, what it counts
now with a plus sign. Totals are sums of deltas, so a batch costs what it changes, not what the corpus holds.

Layout below one folder, parquet throughout: `data/<attempt>/ledger` (doc_id, version, source, lang, docs, tokens: a
document's counts as of the batch, zeros when it is gone), `data/<attempt>/deltas` (source, lang, version, docs, tokens)
and `commits` (batch, attempt). An attempt counts once its row stands in `commits`; that row is one small file. A batch
that is committed is not applied again, and if two writers commit one batch, the attempt with the smaller name counts,
for totals and ledger alike. So a job that dies is run again as it is.

A document's state is the latest ledger row, found for the documents of a batch only. Counting is a map over the changed
texts; what is shuffled is a few numbers per document. Sums are combined before the shuffle, so one source or language
may hold all rows.

Defined results: a null text counts 0 tokens. Inserting a known document revises it, revising an unknown one inserts it,
deleting an unknown one does nothing. Of several changes of a document in one batch the one with the largest seq counts,
null before all, of equals the largest by content. A change without a doc_id is added if it is an insert, once per
batch, and can never be taken back; others without one do nothing. Null sources and languages are groups of their own.
Other kinds of changes are refused by the ledger: they do nothing. Groups without documents and tokens are left out of
the totals. Other columns of the changes play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import read, word_count
from freshet.sources.shared import shared_dir

# Letters, digits, or one other visible character.
PIECES = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"

Counter = Callable[[Column], Column]


def piece_count(text: Column) -> Column:
    """Number of letter runs, digit runs and other characters; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PIECES)).cast("bigint")


def vocabulary_count(path: str) -> Counter:
    """A counter by the tokenizer whose JSON file is at `path`, a place that every executor can open."""
    loaded: list = []

    @F.arrow_udf("bigint")
    def count(text: pa.Array) -> pa.Array:
        from tokenizers import Tokenizer

        if not loaded:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            loaded.append(tokenizer)
        texts = [t or "" for t in text.to_pylist()]
        return pa.array([len(e.ids) for e in loaded[0].encode_batch(texts, add_special_tokens=False)], pa.int64())

    return lambda text: count(text.cast("string"))


COUNTERS: Mapping[str, Counter] = {"words-1": word_count, "pieces-1": piece_count}


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, counters: Mapping[str, Counter] = COUNTERS):
        self.spark, self.path, self.counters = spark, path.rstrip("/"), counters
        spark.createDataFrame([], "batch bigint, attempt string").write.mode("ignore").parquet(f"{self.path}/commits")

    def _attempts(self) -> dict[int, str]:
        """The attempt that counts for each committed batch: one small row per batch."""
        rows = self.spark.read.schema("batch bigint, attempt string").parquet(f"{self.path}/commits")
        return {r.batch: r.attempt for r in rows.groupBy("batch").agg(F.min("attempt").alias("attempt")).collect()}

    def _read(self, part: str, schema: str, attempts: dict[int, str]) -> DataFrame:
        frame = self.spark.createDataFrame([], f"batch bigint, {schema}")
        for batch, attempt in sorted(attempts.items()):
            data = self.spark.read.schema(schema).parquet(f"{self.path}/data/{attempt}/{part}")
            frame = frame.unionByName(data.withColumn("batch", F.lit(batch).cast("bigint")))
        return frame

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Applies `changes` (doc_id, op: insert, delete or revise, seq, source, lang, text) as batch number `batch`.

        False if the batch is committed already. Batches come in ascending order.
        """
        attempts = self._attempts()
        if batch in attempts:
            return False
        if attempts and batch < max(attempts):
            raise ValueError(f"batch {batch} is older than batch {max(attempts)}, which is committed")
        attempt = f"{batch:012d}-{uuid.uuid4().hex[:12]}"
        base = f"{self.path}/data/{attempt}"
        gone = F.col("op") == "delete"
        counts = [F.when(gone, F.lit(0).cast("bigint")).otherwise(c(F.col("text"))).alias(f"_{i}") for i, c in enumerate(self.counters.values())]
        counted = changes.where(F.col("op").isin("insert", "delete", "revise")).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("op"), F.col("seq").cast("bigint").alias("seq"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
            (~gone).cast("int").alias("docs"), *counts,
        )
        entry = ["seq", "op", "source", "lang", "docs", *[f"_{i}" for i in range(len(counts))]]
        latest = counted.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct(*entry)).alias("e")).select("doc_id", "e.*")
        nameless = counted.where("doc_id is null and op = 'insert'").select("doc_id", *entry)
        versions = F.explode(
            F.array(*[F.struct(F.lit(v).alias("version"), F.col(f"_{i}").alias("tokens")) for i, v in enumerate(self.counters)])
        )
        ledger = latest.unionByName(nameless).select("doc_id", "source", "lang", "docs", versions.alias("v")).select(
            "doc_id", F.col("v.version").alias("version"), "source", "lang", "docs", F.col("v.tokens").alias("tokens")
        )
        ledger.write.parquet(f"{base}/ledger")
        self._deltas(base, attempts).write.parquet(f"{base}/deltas")
        commit = self.spark.createDataFrame([(batch, attempt)], "batch bigint, attempt string")
        commit.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    _LEDGER = "doc_id bigint, version string, source string, lang string, docs int, tokens bigint"
    _DELTAS = "source string, lang string, version string, docs bigint, tokens bigint"

    def _deltas(self, base: str, attempts: dict[int, str]) -> DataFrame:
        """What the ledger rows written below `base` change: new counts less those of the documents' latest state."""
        new = self.spark.read.schema(self._LEDGER).parquet(f"{base}/ledger")
        ids = new.where("doc_id is not null").select("doc_id").distinct()
        state = self._read("ledger", self._LEDGER, attempts).where("doc_id is not null").join(ids, "doc_id", "left_semi")
        # A tokenizer version that a batch does not count keeps its latest row.
        kept = [F.lit(v) for v in self.counters]
        old = (
            state.where(F.col("version").isin(*kept))
            .groupBy("doc_id", "version")
            .agg(F.max(F.struct("batch", "source", "lang", "docs", "tokens")).alias("e"))
            .select("e.source", "e.lang", "version", (-F.col("e.docs")).alias("docs"), (-F.col("e.tokens")).alias("tokens"))
        )
        both = new.select("source", "lang", "version", "docs", "tokens").unionByName(old)
        summed = both.groupBy("source", "lang", "version").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """source, lang, version, docs and tokens over all committed batches."""
        deltas = self._read("deltas", self._DELTAS, self._attempts())
        summed = deltas.groupBy("source", "lang", "version").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 or tokens <> 0")


# Batches made from the documents: all of them; deletes and revised texts, one of them overtaken in the same batch; some
# that come back in another language, move to another source or lose their text.
BATCHES = (
    (1, ("doc_id, 'insert' as op, 1 as seq, source, lang, text",)),
    (
        2,
        (
            "doc_id, case when doc_id % 10 = 3 then 'delete' else 'revise' end as op, 2 as seq, source, lang, "
            "text || ' ' || text as text",
            "doc_id, 'revise' as op, 1 as seq, source, lang, 'overtaken' as text",
        ),
    ),
    (
        3,
        (
            "doc_id, case when doc_id % 10 = 3 then 'insert' else 'revise' end as op, 3 as seq, "
            "case when doc_id % 10 = 5 then 'moved' else source end as source, "
            "case when doc_id % 10 = 3 then cast(null as string) else lang end as lang, "
            "case when doc_id % 10 = 9 then cast(null as string) else text end as text",
        ),
    ),
)
WHICH = {1: "true", 2: "doc_id % 10 in (3, 7)", 3: "doc_id % 20 = 3 or doc_id % 10 in (5, 9)"}


def op6_delta_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rollup = Rollup(spark, shared_dir(spark, "token-rollups"))
    for batch, selects in (*BATCHES, BATCHES[1]):
        changed = docs.where(WHICH[batch])
        changes = changed.selectExpr(*_split(selects[0]))
        for more in selects[1:]:
            changes = changes.unionByName(changed.selectExpr(*_split(more)))
        rollup.apply(batch, changes)
    return rollup.totals()


def _split(select: str) -> list[str]:
    """The expressions of a select list; none of them has a comma and a blank within."""
    return select.split(", ")


SQL = f"""
with now as (select case when doc_id % 10 = 5 then 'moved' else source end as source,
  case when doc_id % 10 = 3 then null else lang end as lang,
  coalesce(case when doc_id % 10 = 7 then text || ' ' || text when doc_id % 10 = 9 then null else text end, '') as text
  from documents where doc_id is null or doc_id % 10 <> 3 or doc_id % 20 = 3),
counts as (select source, lang, 'words-1' as version,
  len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as tokens from now
  union all select source, lang, 'pieces-1', len(regexp_extract_all(text, '{PIECES}')) from now)
select source, lang, version, cast(count(*) as bigint) as docs, cast(sum(tokens) as bigint) as tokens
from counts group by all"""
