"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.sources.shared import shared_dir

# Words are runs of anything but the six ASCII white space characters.
SPACE = r"[\x20\x09-\x0D]+"
# Rows of a shuffled group that are numbered together, and groups of rows whose totals are added up together.
RUN_ROWS = 64
RUNS = 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written below spark.checkpoint.dir and read again: lineage is cut and lost executors cost nothing.

    The schema is stated, so that an empty table and one without part files read alike.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def named_key(value: Column) -> Column:
    """A string that stands for `value` and is never null, for joins and groups where null is a value of its own."""
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value.cast("string")))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    words = F.split(F.coalesce(text, F.lit("")), SPACE)
    edges = (F.element_at(words, 1) == "").cast("int") + (
        (F.size(words) > 1) & (F.element_at(words, -1) == "")
    ).cast("int")
    return (F.size(words) - edges).cast("bigint")


def hex_bits(digest: Column, start: int, digits: int) -> Column:
    """`digits` hexadecimal digits of a digest from position `start` (counted from 1) as a number."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 32) -> DataFrame:
    """Inner join on `key`, one row per key in `small`, of which one key may hold most rows of `big`.

    The rows of a key are dealt over `salts` parts and each row of `small` is repeated as often, so no part of a join
    holds a whole hot key, and what is partitioned afterwards by more columns is dealt out anew.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    return left.join(small.withColumn("_salt", parts), [key, "_salt"]).drop("_salt")


def shuffled_offsets(df: DataFrame, group: str, digest: str, ties: list[str], size: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `size` over the rows of the same `group` that come before in the order of `digest`.

    `digest` is a column of evenly spread hexadecimal digests, so a row's place is known roughly beforehand: each group
    is cut into runs of about RUN_ROWS rows by the value of the digest, as many as its row count asks for. Rows are
    ordered inside a run, runs inside a block of RUNS runs, blocks inside the group. One group may hold all rows; no
    task sorts more than a run, a block, or one number per RUN_ROWS * RUNS rows. Equal digests are ordered by `ties`.
    """
    # 13 digits are 52 bits, exact as a double.
    place = hex_bits(F.col(digest), 1, 13).cast("double") / F.lit(float(1 << 52))
    counts = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / RUN_ROWS).cast("double").alias("_runs"))
    runs = salted_join(df, counts, group).withColumn("_run", F.floor(place * F.col("_runs")).cast("bigint"))
    runs = runs.withColumn("_block", F.floor(F.col("_run") / RUNS).cast("bigint")).drop("_runs")

    def before(over: list[str], order: list[str], value: str) -> Column:
        window = Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0).cast("bigint"))

    keys = [group, "_block", "_run"]
    totals = runs.groupBy(*keys).agg(F.sum(size).alias("_total"))
    blocks = totals.groupBy(group, "_block").agg(F.sum("_total").alias("_total"))
    blocks = blocks.select(group, "_block", before([group], ["_block"], "_total").alias("_before_block"))
    shifts = (
        totals.withColumn("_before_run", before([group, "_block"], ["_run"], "_total"))
        .join(blocks, [group, "_block"])
        .select(*keys, (F.col("_before_run") + F.col("_before_block")).alias("_shift"))
    )
    inside = runs.withColumn("_inside", before(keys, [digest, *ties], size))
    return inside.join(shifts, keys).withColumn(name, F.col("_inside") + F.col("_shift")).drop(
        "_block", "_run", "_inside", "_shift"
    )


def in_order(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """`df` written in the order of `by`, with `_id`: ascending in that order, without gaps inside a written part.

    Rows are dealt out by ranges of `by` and, among equals, of their place in the input, so that a flood of equal rows
    is split as well. The input is read twice, once to find the ranges; write it first if it is dear.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    sorted_rows = placed.repartitionByRange(*by, "_place").sortWithinPartitions(*by, "_place")
    return written(sorted_rows.drop("_place").withColumn("_id", F.monotonically_increasing_id()), name)


def ranked(ordered: DataFrame, group: str, name: str) -> DataFrame:
    """Adds `name` to what `in_order` returned: a row's place in its group from 0. Rows of a group follow each other.

    There is one number per part and group, summed over the parts of a group; no window sees rows of the table itself.
    `group` is never null.
    """
    part = F.shiftright("_id", 33).alias("_part")
    firsts = ordered.groupBy(group, part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = firsts.select(
        group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")) - F.col("_first")).alias("_shift")
    )
    joined = ordered.withColumn("_part", part).join(shifts, [group, "_part"])
    return joined.withColumn(name, F.col("_id") + F.col("_shift")).drop("_part", "_shift")


def total_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
