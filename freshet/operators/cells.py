"""An inverted file over vectors: coarse cells, stored by cell, of which a question reads a few.

Centroids are fitted once, on a bounded sample; every vector of the table is assigned to its nearest one and written
below a folder of that cell. A question looks at the cells whose centroids are nearest to it, and partition pruning
leaves all other files unread. How many cells that are is measured when the centroids are fitted: the fewest that find
the wanted share of the true neighbours in the sample. Vectors without clear groups need many cells, grouped ones few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.search import Scan, TIE_PLACES, best_k, matrix_of, unit_rows

# Vectors that centroids are fitted on, and of these, questions that the number of cells is measured with.
SAMPLE, SAMPLE_QUESTIONS = 65_536, 512
MOST_CELLS = 4_096
# Questions whose cells are chosen at a time.
QUESTIONS_AT_ONCE = 1_024
ROUNDS = 2
# Centroids are kept to so many places, so that their values do not depend on the order of a sum.
CENTROID_PLACES = 6
CELL = "cell"
_STORED = "centroids array<array<double>>, probes int"


def _nearest(scores: np.ndarray, n: int) -> np.ndarray:
    """The n best columns of each row; equal ones in the order of columns."""
    if n == 1:
        return np.nan_to_num(np.round(scores, TIE_PLACES), nan=-np.inf).argmax(axis=1)[:, None]
    return np.argsort(-np.round(scores, TIE_PLACES), axis=1, kind="stable")[:, :n]


@dataclass(frozen=True)
class Cells:
    """Unit centroids, one row per cell, and how many of them a question looks at."""

    centroids: np.ndarray
    probes: int

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def cell_of(self, vector: Column) -> Column:
        """Number of the cell whose centroid is nearest."""
        centroids = self.centroids

        @F.arrow_udf("int")
        def nearest(vectors: pa.Array) -> pa.Array:
            found = [
                _nearest(unit_rows(matrix_of(vectors.slice(i, 4096), np.float64)) @ centroids.T, 1)[:, 0]
                for i in range(0, len(vectors), 4096)
            ]
            return pa.array(np.concatenate(found) if found else [], pa.int32())

        return nearest(vector)

    def probed(self, questions: np.ndarray, probes: int | None = None) -> np.ndarray:
        """The cells each question (a unit row) looks at, nearest first."""
        return _nearest(questions @ self.centroids.T, probes or self.probes)

    def looked_at(self, questions: np.ndarray, probes: int | None = None) -> np.ndarray:
        """The same as a table: a row per cell, a column per question, true where the question looks at the cell."""
        n = min(probes or self.probes, len(self.centroids))
        found = np.ones((len(self.centroids), len(questions)), bool)
        if n == len(self.centroids):
            return found
        for start in range(0, len(questions), QUESTIONS_AT_ONCE):
            some = slice(start, start + QUESTIONS_AT_ONCE)
            far = -np.round(questions[some] @ self.centroids.T, TIE_PLACES)
            last = np.partition(far, n - 1, axis=1)[:, n - 1 :][:, :1]
            nearer, tied = far < last, far == last
            left = n - nearer.sum(axis=1, keepdims=True)
            found[:, some] = (nearer | (tied & (tied.cumsum(axis=1) <= left))).T
        return found


def fit(
    vectors: DataFrame, dim: int, *, id_column: str = "chunk_id", cells: int | None = None, probes: int | None = None,
    rounds: int = ROUNDS, sample: int = SAMPLE, recall: float = 0.97, k: int = 5,
) -> Cells:
    """Cells for the vectors of dimension `dim`: as many as the square root of their number, MOST_CELLS at most.

    The first centroids are the vectors first in the order of a hash of their id; then `rounds` rounds move each to the
    mean of its members. At most `sample` vectors, the first in that order, come to the driver.
    """
    usable = vectors.where(F.size("embedding") == dim).select(F.col(id_column).cast("string").alias("i"), "embedding")
    count = usable.count()
    if not count:
        return Cells(np.zeros((1, dim)), 1)
    some = usable.orderBy(F.md5("i"), "i").limit(sample).toArrow()
    units = unit_rows(matrix_of(some["embedding"], np.float64))
    wanted = min(cells or min(MOST_CELLS, int(np.ceil(np.sqrt(count)))), len(units))
    centroids = units[:wanted].round(CENTROID_PLACES)
    for _ in range(rounds):
        mine = np.concatenate([_nearest(units[i : i + 4096] @ centroids.T, 1)[:, 0] for i in range(0, len(units), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, mine, units)
        members = np.bincount(mine, minlength=wanted)[:, None]
        means = unit_rows(np.divide(sums, members, out=np.zeros_like(sums), where=members > 0))
        centroids = np.where(members > 0, means, centroids).round(CENTROID_PLACES)
    found = Cells(centroids, wanted)
    return Cells(centroids, probes or _probes_for(found, units, recall, k))


def _probes_for(cells: Cells, units: np.ndarray, recall: float, k: int) -> int:
    """The fewest cells in which questions of the sample find the share `recall` of their k nearest in the sample."""
    asked = units[:: max(1, len(units) // SAMPLE_QUESTIONS)][:SAMPLE_QUESTIONS]
    near = _nearest(asked @ units.T, k)
    homes = np.concatenate([_nearest(units[i : i + 4096] @ cells.centroids.T, 1)[:, 0] for i in range(0, len(units), 4096)])
    order = cells.probed(asked, len(cells.centroids))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, homes[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def build(corpus: DataFrame, cells: Cells, path: str, id_column: str = "chunk_id") -> None:
    """Write ids and vectors of `corpus` below `path`, one folder per cell, and the cells beside them.

    Rows of a cell are brought together by a rebalance, which splits a hot cell over several files. Rows of another
    dimension or without a vector are left out, as in an exact search.
    """
    usable = corpus.where(F.size("embedding") == cells.dim).select(id_column, "embedding")
    rows = usable.withColumn(CELL, cells.cell_of(F.col("embedding"))).hint("rebalance", CELL)
    rows.sortWithinPartitions(CELL).write.mode("overwrite").partitionBy(CELL).parquet(f"{path}/vectors")
    spark = corpus.sparkSession
    stored = spark.createDataFrame([(cells.centroids.tolist(), cells.probes)], _STORED)
    # Written last: an index without it is not complete.
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def load(spark: SparkSession, path: str) -> Cells:
    row = spark.read.schema(_STORED).parquet(f"{path}/cells").first()
    return Cells(np.array(row["centroids"], dtype=np.float64), row["probes"])


def is_built(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/cells/_SUCCESS")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def knn_cells(
    spark: SparkSession, path: str, questions: DataFrame, k: int = 5, *, id_type: str = "string", id_column: str = "chunk_id",
    probes: int | None = None, block: int | None = None,
) -> DataFrame:
    """Top-k from the cells each question looks at: (query_id, <id_column>, score, rank); scores are exact.

    `questions` is (query_id, embedding). Only the folders of cells that a question of the block looks at are read, and
    a task scores a cell's vectors against the questions that look at this cell.
    """
    cells = load(spark, path)
    schema = T.StructType.fromDDL(f"{id_column} {id_type}, embedding array<float>, {CELL} int")
    index = spark.read.schema(schema).parquet(f"{path}/vectors").select(
        F.col(id_column).alias("id"), F.col("embedding").alias("v"), CELL
    )
    asked = questions.where(F.size("embedding") == cells.dim).select("query_id", F.col("embedding").alias("v"))

    def scan(block_of: pa.Table) -> tuple[DataFrame, Scan]:
        units = unit_rows(matrix_of(block_of["v"], np.float64)) if block_of.num_rows else np.zeros((0, cells.dim))
        wanted = np.flatnonzero(cells.looked_at(units, probes).any(axis=1)).tolist()

        def search(best, batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> None:
            # Which question looks where is found again by the task: as a list it would be sent many times over.
            asking, coarse = cells.looked_at(matrix, probes), matrix.astype(np.float32)
            for batch in batches:
                homes = batch.column(CELL).to_numpy(zero_copy_only=False)
                for c in np.unique(homes):
                    rows = pa.array(np.flatnonzero(homes == c))
                    best.search_some(batch.column("id").take(rows), batch.column("v").take(rows), matrix, np.flatnonzero(asking[c]), coarse)

        return index.where(F.col(CELL).isin(wanted)), search

    # A question is its vector and a byte per cell.
    width = max(cells.dim, len(cells.centroids) // 8)
    return best_k(asked, k, index.schema["id"], width, block, scan).withColumnRenamed("id", id_column)
