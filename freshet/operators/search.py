"""Vector search for a table of questions.

Pairs of question and chunk are never rows. A task scores its chunks against all questions in one matrix product and
passes on only its best k per question. There are a few such tasks per core, however many splits the table has, each
merging the best of its splits before anything is shuffled; those short rows are thinned out in parts before the last
window sees them.

Questions that fill more than one block never pass the driver: questions and chunks are dealt out over the cells of a
grid, and a task holds the questions of one cell while the cell's chunks stream by.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from freshet.functions.sizes import SLIM_ROWS
from freshet.functions.vectors import similarity

# Questions, and question values (questions x dimensions), that may be broadcast: at most 64 MB as doubles.
BROADCAST_QUESTIONS, BROADCAST_VALUES = 16_384, 8_000_000
# Scores (chunks x questions) computed at a time: 4 MB.
SCORES_AT_ONCE = 500_000
# Parts in which the hits of a question are thinned out first.
PARTS = 32
# Scores equal to this many places are ties, decided by id: results do not depend on the summation order.
TIE_PLACES = 9


# Approximate candidates re-scored per result wanted, and at least.
CANDIDATES_PER_HIT, CANDIDATES_AT_LEAST = 20, 100


def candidates_for(k: int) -> int:
    """How many approximate candidates to re-score for k results."""
    return max(CANDIDATES_AT_LEAST, CANDIDATES_PER_HIT * k)


def matrix_of(vectors: pa.Array, dtype) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten(), dtype=dtype)
    return flat.reshape(len(vectors), -1)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


class _Best:
    """Running best k per question of one task."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.kept: list[list[tuple]] = [[] for _ in range(questions)]  # (-tie score, id, score)
        self.floor = np.full(questions, -np.inf)

    def search(self, score: Scores, ids: pa.Array, vectors: pa.Array, questions: np.ndarray) -> None:
        """Score all chunks against all questions, a bounded number of scores at a time."""
        rows = max(1, SCORES_AT_ONCE // max(1, len(questions)))
        for start in range(0, len(ids), rows):
            some = slice(start, start + rows)
            self.add(score(vectors[some], questions), ids[some].to_pylist())

    def search_some(
        self, ids: pa.Array, vectors: pa.Array, questions: np.ndarray, which: np.ndarray, coarse: np.ndarray
    ) -> None:
        """The same by cosine for the questions numbered `which` only. `coarse` are the questions in single precision: by
        it pairs are left out that cannot be among the best, and the others are scored exactly."""
        if not len(ids):
            return
        units, names = unit_rows(matrix_of(vectors, np.float64)), ids.to_pylist()
        rough, dim = units.astype(np.float32), units.shape[1]
        # Twice what two products of unit vectors may be off by in single precision; ties are far within.
        margin = (dim + 16) * float(np.finfo(np.float32).eps)
        at_once = max(1, SCORES_AT_ONCE // len(names))
        for start in range(0, len(which), at_once):
            some = which[start : start + at_once]
            products = coarse[some] @ rough.T
            least = 2 * self.floor[some] - 1
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and len(names) > self.k:
                least[new] = -np.partition(-products[new], self.k - 1, axis=1)[:, self.k - 1]
            asked, row = np.nonzero(products >= (least - margin).astype(np.float32)[:, None])
            scores = (np.einsum("ij,ij->i", units[row], questions[some[asked]]) + 1) / 2
            tied = np.round(scores, TIE_PLACES)
            good = np.flatnonzero(tied >= self.floor[some[asked]])
            if not len(good):
                continue
            asked, row, scores, tied = asked[good], row[good], scores[good], tied[good]
            cuts = [0, *(np.flatnonzero(asked[1:] != asked[:-1]) + 1).tolist(), len(asked)]
            rows, exact, ties = row.tolist(), scores.tolist(), tied.tolist()
            for q, low, high in zip(some[asked[cuts[:-1]]].tolist(), cuts[:-1], cuts[1:]):
                self._keep(q, [(-ties[i], names[rows[i]], exact[i]) for i in range(low, high)])

    def _keep(self, q: int, found: list[tuple]) -> None:
        self.kept[q] = heapq.nsmallest(self.k, self.kept[q] + found)
        if len(self.kept[q]) == self.k:
            self.floor[q] = -self.kept[q][-1][0]

    def add(self, scores: np.ndarray, ids: list) -> None:
        """`scores` has one row per id and one column per question."""
        tied = np.round(scores, TIE_PLACES)
        floor = self.floor
        if len(ids) > self.k:
            kth = -np.partition(-tied, self.k - 1, axis=0)[self.k - 1]
            floor = np.maximum(floor, kth)
        for column in np.flatnonzero((tied >= floor).any(axis=0)):
            rows = np.flatnonzero(tied[:, column] >= floor[column])
            self._keep(column, [(-tied[r, column], ids[r], scores[r, column]) for r in rows])

    def table(self, question_ids: list, schema: pa.Schema) -> pa.Table:
        rows = [(q, i, s) for q, kept in zip(question_ids, self.kept) for _, i, s in kept]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def _cosine_scores(chunks: pa.Array, questions: np.ndarray) -> np.ndarray:
    return (unit_rows(matrix_of(chunks, np.float64)) @ questions.T + 1) / 2


def _bit_scores(sketches: pa.Array, questions: np.ndarray) -> np.ndarray:
    """Share of equal bits, from sketches kept as arrays of 64-bit words."""
    words = matrix_of(sketches, np.int64)
    differing = np.zeros((len(words), len(questions)), dtype=np.int64)
    for w in range(questions.shape[1]):
        differing += np.bitwise_count((words[:, w, None] ^ questions[None, :, w]).view(np.uint64))
    return 1 - differing / (64 * questions.shape[1])


Scores = Callable[[pa.Array, np.ndarray], np.ndarray]
_KINDS: dict[str, tuple[Scores, Callable[[pa.Array], np.ndarray]]] = {
    "cosine": (_cosine_scores, lambda a: unit_rows(matrix_of(a, np.float64))),
    "bits": (_bit_scores, lambda a: matrix_of(a, np.int64)),
}


# What a task does with its batches: fill the best k, given the matrix of questions.
Scan = Callable[["_Best", Iterator[pa.RecordBatch], np.ndarray], None]


def _whole(best: _Best, batches: Iterator[pa.RecordBatch], matrix: np.ndarray, score: Scores) -> None:
    for batch in batches:
        if batch.num_rows:
            best.search(score, batch.column("id"), batch.column("v"), matrix)


def _best_k(corpus: DataFrame, questions: DataFrame, k: int, kind: str, width: int, block: int | None) -> DataFrame:
    """Best k (query_id, id, score) over all of (id, v) for every row of (query_id, v)."""
    score, prepare = _KINDS[kind]
    rows = corpus.select("id", "v")
    count = questions.count()
    if count <= (block or block_of(width)):
        return best_k(questions, k, corpus.schema["id"], width, block, lambda _: (rows, partial(_whole, score=score)), prepare)
    return _best_of(_on_grid(rows, questions.select("query_id", "v"), count, k, kind, width), k, count)


def block_of(width: int) -> int:
    """Questions of `width` values that may be held at once."""
    return max(1, min(BROADCAST_QUESTIONS, BROADCAST_VALUES // max(1, width)))


def _best_of(hits: DataFrame, k: int, count: int) -> DataFrame:
    """The best k of each of `count` questions."""
    best = ranked(_thinned(hits, k), k)
    # At most k hits per question: the bound is known without running the search.
    return F.broadcast(best) if count * k <= SLIM_ROWS else best


def best_k(
    questions: DataFrame, k: int, id_field: T.StructField, width: int, block: int | None,
    scan_for: Callable[[pa.Table], tuple[DataFrame, Scan]], prepare: Callable[[pa.Array], np.ndarray] | None = None,
) -> DataFrame:
    """Best k (query_id, id, score) for every row of (query_id, v).

    Questions are taken in blocks of about `block` rows, each sent to all tasks of one scan of the rows that `scan_for`
    names for the block.
    """
    schema = T.StructType(
        [questions.schema["query_id"], T.StructField("id", id_field.dataType), T.StructField("score", T.DoubleType())]
    )
    block = block or block_of(width)
    count = questions.count()
    blocks = max(1, math.ceil(count / block))
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    hits = None
    for n in range(blocks):
        # One block of questions at a time comes to the driver.
        asked = questions.where(number == n).select("query_id", "v").toArrow()
        rows, scan = scan_for(asked)
        found = _scanned(rows, asked, k, schema, scan, prepare or _KINDS["cosine"][1], blocks)
        hits = found if hits is None else hits.unionByName(found)
    return _best_of(hits, k, count)


# Cells of a grid per scan task, so that the tasks end up with about equal shares.
CELLS_PER_TASK = 4


def _on_grid(corpus: DataFrame, questions: DataFrame, count: int, k: int, kind: str, width: int) -> DataFrame:
    """(query_id, id, score): of each question the best k of each stripe of the corpus.

    A cell is a part of the questions, as many as a task may hold, and a stripe of the corpus. Rows are copied to the
    cells that they belong to: a chunk once for each part of the questions, a question once for each stripe.
    """
    score, prepare = _KINDS[kind]
    spark = corpus.sparkSession
    across = math.ceil(count / block_of(width))
    down = max(1, math.ceil(CELLS_PER_TASK * scan_tasks(spark) / across))
    id_type, query_type = corpus.schema["id"].dataType, questions.schema["query_id"].dataType

    def everywhere(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    asked = questions.select(
        F.pmod(F.xxhash64("query_id", "v"), F.lit(across)).cast("int").alias("_part"), everywhere(down).alias("_stripe"),
        F.lit(False).alias("_chunk"), "query_id", F.lit(None).cast(id_type).alias("id"), "v",
    )
    chunks = corpus.select(
        everywhere(across).alias("_part"), F.pmod(F.xxhash64("id", "v"), F.lit(down)).cast("int").alias("_stripe"),
        F.lit(True).alias("_chunk"), F.lit(None).cast(query_type).alias("query_id"), "id", "v",
    )
    dealt = asked.unionByName(chunks).select((F.col("_part") * down + F.col("_stripe")).alias("cell"), "_chunk", "query_id", "id", "v")
    schema = T.StructType(
        [questions.schema["query_id"], T.StructField("id", id_type), T.StructField("score", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, vectors, best, matrix = None, [], [], None, None
        for number, is_chunk, rows in _stretches(batches):
            if number != cell:
                if best:
                    yield from best.table(ids, arrow).to_batches()
                cell, ids, vectors, best = number, [], [], None
            if not is_chunk:
                ids += rows.column("query_id").to_pylist()
                vectors.append(prepare(rows.column("v")))
            elif ids:
                if not best:
                    best, matrix = _Best(len(ids), k), np.concatenate(vectors)
                best.search(score, rows.column("id"), rows.column("v"), matrix)
        if best:
            yield from best.table(ids, arrow).to_batches()

    return dealt.repartition(across * down, "cell").sortWithinPartitions("cell", "_chunk").mapInArrow(search, schema)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(cell, whether they are chunks, rows) of consecutive rows of one cell and kind."""
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = 2 * batch.column("cell").to_numpy().astype(np.int64) + batch.column("_chunk").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist(), len(kind)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield int(kind[low]) // 2, bool(kind[low] % 2), batch.slice(low, high - low)


def scan_tasks(spark: SparkSession) -> int:
    """Tasks that a scan is merged into: two per core, and no fewer than a shuffle has, should cores still be starting."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _scanned(
    rows: DataFrame, asked: pa.Table, k: int, schema: T.StructType, scan: Scan, prepare: Callable[[pa.Array], np.ndarray],
    blocks: int = 1,
) -> DataFrame:
    """Each task's best k for every question of one block. A task takes several splits one after the other and passes on
    one best k for all of them, so that what is shuffled grows with the cores and not with the splits. The scans of
    several `blocks` run side by side and share the tasks."""
    arrow = to_arrow_schema(schema)
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((asked["query_id"].to_pylist(), prepare(asked["v"]) if asked.num_rows else None))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        question_ids, matrix = shared.value
        best = _Best(len(question_ids), k)
        if question_ids:
            scan(best, batches, matrix)
        yield from best.table(question_ids, arrow).to_batches()

    return rows.coalesce(math.ceil(scan_tasks(spark) / blocks)).mapInArrow(search, schema)


def _thinned(hits: DataFrame, k: int) -> DataFrame:
    """The best k of each of PARTS parts of a question's hits, so that no task sorts the hits of all scan tasks."""
    part = hits.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    order = Window.partitionBy("query_id", "_part").orderBy(F.desc(F.round("score", TIE_PLACES)), "id")
    return part.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n", "_part")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """First k per question by score, then id; adds `rank` from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", TIE_PLACES)), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_exact(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = 5,
    *,
    dim: int,
    id_column: str = "chunk_id",
    where: Column | None = None,
    block: int | None = None,
) -> DataFrame:
    """Exact cosine top-k: (query_id, <id_column>, score, rank).

    `questions` is (query_id, embedding). The corpus is scanned in place, unshuffled, for up to `block` questions (by
    default BROADCAST_QUESTIONS or as many as fit BROADCAST_VALUES). More questions than that are not sent to the driver
    but meet the corpus in a grid, whose shuffle holds the corpus once for each default block. `where` filters the corpus before the search. Rows whose vector has another dimension are not searched.
    """
    if where is not None:
        corpus = corpus.where(where)
    usable = F.size("embedding") == dim
    chunks = corpus.where(usable).select(F.col(id_column).alias("id"), F.col("embedding").alias("v"))
    asked = questions.where(usable).select("query_id", F.col("embedding").alias("v"))
    return _best_k(chunks, asked, k, "cosine", dim, block).withColumnRenamed("id", id_column)


@lru_cache(maxsize=4)
def planes(dim: int, bits: int) -> np.ndarray:
    """A sign per dimension and bit, from a digest, so that any engine draws the same ones."""
    return np.array(
        [[1.0 if hashlib.md5(f"{b}:{d}".encode()).hexdigest() < "8" else -1.0 for b in range(bits)] for d in range(dim)]
    )


def sketch(embedding: Column, dim: int, bits: int = 256) -> Column:
    """Signs of `bits` projections as an array of 64-bit words: 32 bytes instead of 4 per dimension."""

    @F.arrow_udf("array<bigint>")
    def signs(vectors: pa.Array) -> pa.Array:
        m = matrix_of(vectors, np.float64)
        words = np.packbits(m @ planes(dim, bits) > 0, axis=1).view(np.int64) if len(m) else np.zeros((0, bits // 64), np.int64)
        offsets = np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.reshape(-1)))

    return signs(embedding)


def knn_approximate(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = 5,
    *,
    dim: int,
    id_column: str = "chunk_id",
    bits: int = 256,
    candidates: int | None = None,
) -> DataFrame:
    """Approximate top-k: the best `candidates` per question by sketch, re-scored exactly.

    The first pass reads only ids and sketches (a `sketch` column of the corpus is used when present, so it can be
    stored once), the second only the candidates' vectors. There are no hash buckets, hence no hot ones.
    """
    usable = F.size("embedding") == dim
    if "sketch" not in corpus.columns:
        corpus = corpus.where(usable).withColumn("sketch", sketch(F.col("embedding"), dim, bits))
    asked = questions.where(usable)
    found = _best_k(
        corpus.select(F.col(id_column).alias("id"), F.col("sketch").alias("v")),
        asked.select("query_id", sketch(F.col("embedding"), dim, bits).alias("v")),
        candidates or candidates_for(k), "bits", bits // 64, None,
    )
    vectors = corpus.select(F.col(id_column).alias("id"), F.col("embedding").alias("_v"))
    pairs = vectors.join(found.select("query_id", "id"), "id").join(asked.select("query_id", F.col("embedding").alias("_q")), "query_id")
    scored = pairs.select("query_id", "id", similarity(F.col("_q"), F.col("_v")).alias("score"))
    return ranked(scored, k).withColumnRenamed("id", id_column)


def with_payload(hits: DataFrame, corpus: DataFrame, columns: list[str], id_column: str = "chunk_id") -> DataFrame:
    """Hits with columns of their chunks. Texts are read here, for the hits only, not during the search.

    Hits of a bounded number of questions come marked for broadcast, so the corpus is not shuffled for them.
    """
    return corpus.select(id_column, *columns).join(hits, id_column)
