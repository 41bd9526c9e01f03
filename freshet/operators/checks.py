"""Constraints of the tables, as queries that must come out empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_chunk_ids(table: DataFrame) -> DataFrame:
    return table.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def wrong_dimensions(table: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector or recorded dimension differs from the table's; also rows without a vector."""
    size = F.coalesce(F.size("embedding"), F.lit(-1))
    return table.where((size != dim) | (F.coalesce(F.col("dim"), F.lit(-1)) != dim)).select(
        "chunk_id", "dim", size.alias("vector_size")
    )


def models_in_use(table: DataFrame) -> DataFrame:
    return table.groupBy("model", "dim").agg(F.count(F.lit(1)).alias("chunks"))
