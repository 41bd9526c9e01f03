"""Decisions by a measured size: what to broadcast, what to spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a slim table (ids, hashes, counters; at most about 200 bytes each) that may be broadcast: about 40 MB.
SLIM_ROWS = 200_000
# Hashes of keys, 8 bytes each, that may be broadcast: about 60 MB as a hash table.
KEY_ROWS = 1_000_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether `df` has at most `rows` rows; reads no further than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = SLIM_ROWS) -> DataFrame:
    """`df` marked for broadcast when its row count is proven small, otherwise as it is, for a shuffled join.

    Without the mark the planner would shuffle the big side first and learn the small size too late. Pass a persisted
    or written table, since it is counted here. Shuffled joins rely on adaptive skew splitting for hot keys.
    """
    return F.broadcast(df) if at_most(df, rows) else df


def likely(df: DataFrame, some: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `df` whose `keys` are those of a row of `some`, and perhaps, by equal hashes, very few others.

    To be used before a shuffled join, so that wide rows that cannot match are not shuffled. `some` has KEY_ROWS rows at
    most; its keys are broadcast as one hash each.
    """
    hashes = some.select(F.xxhash64(*keys).alias("_hash"))
    return df.join(F.broadcast(hashes), F.xxhash64(*[df[k] for k in keys]) == F.col("_hash"), "left_semi")


def spread(df: DataFrame) -> DataFrame:
    """A table scan in at least as many partitions as there are cores.

    A few large row groups would leave most cores idle in the CPU-heavy steps that follow. With enough input splits,
    as any large table has, this does nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class Kept:
    """Slim tables kept for the length of a `with` block. A lost executor's part is computed again."""

    def __enter__(self) -> Kept:
        self._tables: list[DataFrame] = []
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        self._tables.append(df.persist())
        return df

    def __exit__(self, *_) -> None:
        for df in self._tables:
            df.unpersist()
