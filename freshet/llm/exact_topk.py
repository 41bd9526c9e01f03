"""Exact top-k by inner product over a vector-approximation file.

Vectors are whole numbers: floor(SCALE * x) of each component. The approximation file holds, for each vector, the number
of the cell of width CELL that each component falls into, one byte a component where they fit. For a query q the cells
of a vector bound its score from both sides:

    upper = sum_d max(q_d * low_d, q_d * (low_d + CELL - 1)),   lower = the same with min.

Pass 1 scans the cells only. The k-th best lower bound over all vectors is a floor that the k-th result cannot be below.
Pass 2 scans the cells again, and reads exact vectors in the order of their upper bounds, best first, until no bound
reaches the k-th exact score seen so far or the floor. What is left of a task are the few vectors that may be in the
result; a window over them gives the result. No pair of a query and a vector is ever shuffled for the sake of its bound.

Queries are taken in blocks of QUERY_BLOCK, each sent to all tasks: a block is a bounded amount of memory, and more
queries are more passes.

A vector that very many rows share would fill every result's ties: of equal vectors only the k + 1 smallest ids can be
in a result (one of them may be the query's own), each with k rows at most, so the others leave first, salted so that a
hot vector is spread.

Sums that could leave 64 bits are formed in integers of any size. They are compared cut to 64 bits, which keeps their
order as far as it matters: a result whose score does not fit is an error, as it is in SQL.

Defined results: vectors that are null or hold null or non-finite components take no part, and neither do rows without
an id. A component that is no 64-bit number after scaling is an error, as it is in SQL. Vectors are scored against queries of the same length only;
those without components score 0. Repeated ids: rows with the query's id are not its candidates, others stand for
themselves. Fewer than k candidates give fewer rows; an empty table gives none. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import read, written

SCALE = 1024
CELL = 8
K = 10
QUERY_BLOCK = 4096
ROWS = 1024
SALTS = 16
LOWEST, HIGHEST = np.int64(-(1 << 63)), np.int64((1 << 63) - 1)


def whole_vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and v (array of whole numbers) of the rows that take part."""
    given = F.col(vector).cast("array<double>")
    far = F.raise_error(F.lit("a component is no 64-bit number after scaling")).cast("bigint")
    x = F.transform(given, lambda c: F.when(F.abs(c * F.lit(float(scale))) < float(1 << 63), F.floor(c * F.lit(float(scale)))).otherwise(far))
    ok = F.forall(given, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return table.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & ok).select(
        F.col(id_column).cast("bigint").alias("vec_id"), x.alias("v")
    )


def _few_of_equals(vectors: DataFrame, k: int) -> DataFrame:
    """Of each vector the k + 1 smallest ids, and of each of these at most k rows.

    A query's own rows are no candidates, whatever their number; k other ids are left beside its own. Rows are counted
    before anything else, so rows that share vector and id are one; a salt spreads a vector that many ids share.
    """
    kept = vectors.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("_rows")).withColumn(
        "_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    )
    for by in (["v", "_salt"], ["v"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
        kept = kept.withColumn("_n", place).where(F.col("_n") <= k + 1).drop("_n")
    rows = F.sequence(F.lit(1).cast("bigint"), F.least(F.col("_rows"), F.lit(k)))
    return kept.withColumn("_row", F.explode(rows)).select("vec_id", "v")


def approximation_file(vectors: DataFrame, cell: int = CELL) -> DataFrame:
    """vec_id, cells (the numbers of the cells) and v, written so that a scan of the cells alone reads nothing else."""
    # Division of whole numbers, rounded down: as doubles, large ones would fall into other cells.
    cells = F.expr(f"transform(v, c -> (c div {cell}) - if(c % {cell} < 0, 1L, 0L))")
    small = F.forall(cells, lambda c: c.between(-128, 127))
    return written(
        vectors.select(
            "vec_id",
            F.size("v").alias("dim"),
            F.when(small, cells.cast("array<tinyint>")).alias("cells"),
            F.when(~small, cells).alias("wide_cells"),
            "v",
        ),
        "approximation",
    )


class Block:
    """Queries of one length: ids and vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cell: int):
        self.ids, self.q, self.cell = ids, vectors, cell
        whole = vectors if _most(vectors) < 1 << 31 else vectors.astype(object)
        # Products are exact as doubles while every partial sum stays below 2**53, as 64-bit numbers below 2**62.
        self.largest = int(np.abs(whole).sum(1).max(initial=0))
        if self.largest * cell >= 1 << 62:
            whole = whole.astype(object)
        # What the place within a cell can add to a score, at most and at least.
        self.above = (cell - 1) * np.maximum(whole, 0).sum(1)
        self.below = (cell - 1) * np.minimum(whole, 0).sum(1)

    def product(self, rows: np.ndarray, times: int = 1) -> np.ndarray:
        """Inner products of `times` the rows and the queries, exact."""
        most = _most(rows) * times
        if self.largest * most < 1 << 53:
            return ((rows * times).astype(float) @ self.q.T.astype(float)).astype(np.int64)
        if self.largest * (most + self.cell) < 1 << 62:
            return rows * times @ self.q.T
        return rows.astype(object) * times @ self.q.T.astype(object)

    def lower(self, cells: np.ndarray) -> np.ndarray:
        return _fitted(self.product(cells, self.cell) + self.below)

    def upper(self, cells: np.ndarray) -> np.ndarray:
        return _fitted(self.product(cells, self.cell) + self.above)

    def scores(self, rows: np.ndarray, n: int) -> np.ndarray:
        """Inner products of the rows and query `n`."""
        if self.largest * _most(rows) < 1 << 62:
            return rows @ self.q[n]
        return _fitted(rows.astype(object) @ self.q[n].astype(object))


def _most(values: np.ndarray) -> int:
    """The largest magnitude."""
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def _fitted(sums: np.ndarray) -> np.ndarray:
    """Integers of any size cut to 64 bits."""
    return sums if sums.dtype == np.int64 else np.minimum(np.maximum(sums, int(LOWEST)), int(HIGHEST)).astype(np.int64)


def _matrix(lists: pa.Array, rows: int, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, dim)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, low ends of cells as numbers of cells) of at most ROWS rows of a batch."""
    dims = batch.column("dim").to_numpy()
    wide = ~np.array(batch.column("wide_cells").is_null())
    for dim in np.unique(dims):
        for is_wide in (False, True):
            rows = np.flatnonzero((dims == dim) & (wide == is_wide))
            for at in range(0, len(rows), ROWS):
                some = rows[at : at + ROWS]
                column = batch.column("wide_cells" if is_wide else "cells").take(pa.array(some))
                yield int(dim), some, _matrix(column, len(some), int(dim))


def _floors(blocks: dict[int, Block], k: int):
    """One row per task: for every query the k best lower bounds, in one binary value."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: np.full((len(b.ids), k), LOWEST) for d, b in blocks.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for dim, rows, cells in _by_length(batch):
                if dim not in blocks:
                    continue
                block = blocks[dim]
                lower = block.lower(cells).T
                lower[block.ids[:, None] == ids[rows][None, :]] = LOWEST
                both = np.concatenate([best[dim], lower], axis=1)
                best[dim] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        packed = b"".join(best[d].tobytes() for d in sorted(best))
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["best"])

    return find


def _merged(k: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for packed in batch.column("best"):
                own = np.frombuffer(packed.as_py(), np.int64).reshape(-1, k)
                both = own if best is None else np.concatenate([best, own], axis=1)
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best.tobytes()], pa.binary())], ["best"])

    return merge


def _reads(blocks: dict[int, Block], floors: dict[int, np.ndarray], k: int):
    """query_id, vec_id, score of the vectors of a batch that may be in the result."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = {d: f.copy() for d, f in floors.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            out_q, out_v, out_s = [], [], []
            for dim, rows, cells in _by_length(batch):
                if dim not in blocks:
                    continue
                block, least = blocks[dim], floor[dim]
                upper = block.upper(cells).T
                maybe = (upper >= least[:, None]) & (block.ids[:, None] != ids[rows][None, :])
                exact = None
                for n in np.flatnonzero(maybe.any(1)):
                    if exact is None:
                        exact = _matrix(batch.column("v").take(pa.array(rows)), len(rows), dim)
                    order = np.flatnonzero(maybe[n])
                    order = order[np.argsort(~upper[n, order], kind="stable")]
                    scores = np.zeros(0, np.int64)
                    # Exact vectors, a few at a time, while the next bound still reaches the k-th score.
                    for at in range(0, len(order), 4 * k):
                        if upper[n, order[at]] < least[n]:
                            break
                        scores = np.append(scores, block.scores(exact[order[at : at + 4 * k]], n))
                        if len(scores) >= k:
                            least[n] = max(least[n], np.partition(scores, len(scores) - k)[-k])
                    good = np.flatnonzero(scores >= least[n])
                    out_q.append(np.full(len(good), block.ids[n]))
                    out_v.append(ids[rows][order[good]])
                    out_s.append(scores[good])
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (out_q, out_v, out_s)], ["query_id", "vec_id", "score"]
                )

    return find


def _block_results(file: DataFrame, table: pa.Table, k: int, cell: int) -> DataFrame:
    ids, dims = table.column("vec_id").to_numpy(), table.column("dim").to_numpy()
    vectors = table.column("v").combine_chunks()
    blocks = {}
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        blocks[int(dim)] = Block(ids[rows], _matrix(vectors.take(pa.array(rows)), len(rows), int(dim)), cell)
    cells = file.select("vec_id", "dim", "cells", "wide_cells")
    parts = cells.mapInArrow(_floors(blocks, k), "best binary")
    # One small row per task meets in a few tasks, then in one.
    few = max(1, int(cells.rdd.getNumPartitions() ** 0.5))
    best = parts.repartition(few).mapInArrow(_merged(k), "best binary").coalesce(1).mapInArrow(_merged(k), "best binary").first()
    floors = np.frombuffer(best["best"], np.int64).reshape(-1, k).min(1) if best else np.zeros(0, np.int64)
    by_dim, at = {}, 0
    for dim in sorted(blocks):
        by_dim[dim] = floors[at : at + len(blocks[dim].ids)]
        at += len(blocks[dim].ids)
    return file.select("vec_id", "dim", "cells", "wide_cells", "v").mapInArrow(
        _reads(blocks, by_dim, k), "query_id bigint, vec_id bigint, score bigint"
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of `vectors` for each of `queries`, ties to the smaller id.

    Both have vec_id and v, whole numbers, as `whole_vectors` gives them.
    """
    file = approximation_file(_few_of_equals(vectors, k), cell)
    asked = queries.select("vec_id", F.size("v").alias("dim"), "v").distinct()
    asked = written(asked, "queries")
    count = max(1, -(-asked.count() // QUERY_BLOCK))
    found = None
    for n in range(count):
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(count)) == n).toArrow()
        if not block.num_rows and found is not None:
            continue
        part = _block_results(file, block, k, cell)
        found = part if found is None else found.unionByName(part)
    # What passed the floor is little more than the result; the salt spreads a query that many ties pass for.
    order = [F.col("score").desc(), F.col("vec_id")]
    found = found.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["query_id", "_salt"], ["query_id"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= k)
    far = F.raise_error(F.lit("a score is no 64-bit number")).cast("bigint")
    fits = (F.col("score") > int(LOWEST)) & (F.col("score") < int(HIGHEST))
    return found.select("query_id", "rank", "vec_id", F.when(fits, F.col("score")).otherwise(far).alias("score"))


def op3_vector_approximation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id,
  cast(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= {K}"""
