"""What a table held when it was last synced, and what has changed since.

A snapshot is (doc_id, row_hash), one row per document, in Parquet files bucketed and sorted by doc_id. Two snapshots with
the same number of buckets are compared bucket by bucket: the join shuffles and sorts nothing. Only a new snapshot is
shuffled once, when it is written.

A snapshot counts once it is committed, which a sync does after its changes are indexed: a sync that died is compared with
the same earlier snapshot again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "doc_id STRING, row_hash STRING"


class Snapshots:
    """Snapshots of one table's rows below one folder. `buckets` holds for the folder's whole life; about 100 MB, two
    million rows, in each is a good size."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _path(self, no: int) -> str:
        return f"{self.root}/rows-{self.buckets}/{no}"

    def last(self) -> int:
        """Number of the last committed snapshot; 0 when there is none."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits-{self.buckets}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        return max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0)

    def write(self, versions: DataFrame) -> int:
        """Write the next snapshot from (doc_id, row_hash); of several rows of one document the one with the largest hash
        counts. Returns its number."""
        no = self.last() + 1
        name = f"snapshot_{uuid.uuid4().hex}"
        # Rows are dealt out as the buckets are, so a bucket is one file and its rows are not shuffled again to be grouped.
        dealt = versions.select("doc_id", "row_hash").repartition(self.buckets, "doc_id")
        latest = dealt.groupBy("doc_id").agg(F.max("row_hash").alias("row_hash"))
        writer = latest.write.mode("overwrite").option("path", self._path(no)).option("compression", "zstd").bucketBy(self.buckets, "doc_id")
        writer.sortBy("doc_id").saveAsTable(name)
        self.spark.sql(f"drop table {name}")  # an external table: its files stay
        return no

    def commit(self, no: int) -> None:
        # Fails when another sync was first.
        self.spark.range(1).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/commits-{self.buckets}/{no}")

    def read(self, no: int) -> DataFrame:
        """A snapshot with its buckets known to the planner; number 0 is empty."""
        if no == 0:
            return self.spark.createDataFrame([], VERSIONS).where("false")
        name = f"snapshot_{uuid.uuid5(uuid.NAMESPACE_URL, self._path(no)).hex}"
        self.spark.sql(
            f"create table if not exists {name} ({VERSIONS}) using parquet clustered by (doc_id) sorted by (doc_id) "
            f"into {self.buckets} buckets location '{self._path(no)}'"
        )
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def changes(self, old: int, new: int) -> DataFrame:
        """(doc_id, row_hash, change) of the documents that differ: insert, update, or delete with the hash they had."""
        before = self.read(old).select("doc_id", F.col("row_hash").alias("_was"))
        both = before.join(self.read(new), "doc_id", "full_outer").where(~F.col("_was").eqNullSafe(F.col("row_hash")))
        change = F.when(F.col("_was").isNull(), "insert").when(F.col("row_hash").isNull(), "delete").otherwise("update")
        return both.select("doc_id", F.coalesce("row_hash", "_was").alias("row_hash"), change.alias("change"))
