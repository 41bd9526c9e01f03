"""Which table, index and model a search reads: a one-row table, written after the data it points to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.config import BLUE, GREEN, POINTER, JobConfig
from freshet.schemas import ACTIVE_POINTER
from freshet.sources.tables import TableStore


def default_pointer(spark: SparkSession, config: JobConfig = JobConfig()) -> DataFrame:
    return spark.range(1).select(
        F.lit(BLUE).alias("active_collection"),
        F.lit(config.index_name).alias("active_index"),
        F.lit(config.model).alias("model"),
        F.lit(config.dim).alias("dim"),
    )


def with_default(pointer: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """The pointer row, or the default one when there is none."""
    names = ["active_collection", "active_index", "model", "dim"]
    stored = pointer.select(*names, F.lit(0).alias("_choice"))
    both = stored.unionByName(default_pointer(pointer.sparkSession, config).withColumn("_choice", F.lit(1)))
    return both.agg(F.min_by(F.struct(*names), "_choice").alias("p")).select("p.*")


def other_table(active: Column) -> Column:
    """The table a backfill writes: the other of the pair."""
    return F.when(active == BLUE, GREEN).otherwise(BLUE)


def sample_model(table: DataFrame) -> DataFrame:
    """Model and dimension of the first chunk, empty for an empty table."""
    return table.select("chunk_id", "model", "dim").orderBy("chunk_id").limit(1).select("model", "dim")


def cutover_row(
    target: str, sample: DataFrame, model: str | None = None, dim: int | None = None, config: JobConfig = JobConfig()
) -> DataFrame:
    """The pointer row after a cutover: model and dimension as given, else as sampled, else the defaults."""
    picked = sample.agg(F.first("model").alias("_m"), F.first("dim").alias("_d"))
    return picked.select(
        F.lit(target).alias("active_collection"),
        F.lit(config.index_name).alias("active_index"),
        F.coalesce(F.lit(model), "_m", F.lit(config.model)).alias("model"),
        F.coalesce(F.lit(dim), "_d", F.lit(config.dim)).cast("int").alias("dim"),
    )


def get_active(store: TableStore, config: JobConfig = JobConfig()) -> dict:
    """The active pointer as plain values; one row by definition."""
    if not store.exists(POINTER):
        return default_pointer(store.spark, config).first().asDict()
    return with_default(store.read(POINTER), config).first().asDict()


def set_active(store: TableStore, row: DataFrame) -> dict:
    store.ensure(POINTER, ACTIVE_POINTER)
    store.overwrite(POINTER, row)
    return store.read(POINTER).first().asDict()
