"""Row numbers and running totals without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLAB = 1 << 16


def slab_of(position: Column, width: int = SLAB) -> Column:
    """Number of the slab of `width` consecutive integers, exact for all of BIGINT."""
    position = position.cast("bigint")
    whole = F.call_function("div", position, F.lit(width).cast("bigint"))
    # `div` cuts towards zero; slabs go on evenly below it.
    return whole - F.when((position < 0) & (position % F.lit(width) != 0), 1).otherwise(0)


def running_offset(
    df: DataFrame, position: str, by: list[str], size: Column, name: str, width: int = SLAB, slim: bool = False
) -> DataFrame:
    """Adds `name`: the sum of `size` over the rows before this one in its `by` group, in the order of the integer
    column `position` (unique within a group).

    A plain window would pull a whole group, possibly a third of the table, into one task. Here rows are put into slabs
    of `width` consecutive positions, slabs into blocks of `width` slabs, and so on up to the whole range of a BIGINT.
    Each level is summed inside its parent and shifted by what comes before. No window sees more than `width` rows, be
    the positions dense or scattered over the whole range.

    The slab totals are a second read of the few columns involved, combined map-side. With `slim`, for a `df` that has
    no other columns but is costly to compute, they come from the rows already shuffled, whose exchange is reused.
    """
    levels = [f"_slab{i}" for i in range(-(-64 // (width.bit_length() - 1)) - 1)]
    slabbed = df.withColumn("_size", size.cast("bigint"))
    parent = F.col(position)
    for level in levels:
        slabbed = slabbed.withColumn(level, slab_of(parent, width))
        parent = F.col(level)

    def before(over: list[str], order: str, value: str) -> Column:
        window = Window.partitionBy(*over).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    summed = slabbed.withColumn("_inside", before([*by, *levels], position, "_size"))
    last = (F.max(F.col("_inside") + F.col("_size")) if slim else F.sum("_size")).alias("_total")
    totals = (summed if slim else slabbed).groupBy(*by, *levels).agg(last)
    shifts = None
    for i, level in enumerate(levels):
        above = levels[i + 1 :]
        here = totals.withColumn(f"_shift{i}", before([*by, *above], level, "_total")).drop("_total")
        shifts = here if shifts is None else shifts.join(here, [*by, *levels[i:]])
        totals = totals.groupBy(*by, *above).agg(F.sum("_total").alias("_total"))
    moved = [f"_shift{i}" for i in range(len(levels))]
    total = F.col("_inside")
    for shift in moved:
        total = total + F.col(shift)
    return summed.join(shifts, [*by, *levels]).withColumn(name, total).drop(*levels, "_size", "_inside", *moved)


def number_rows(df: DataFrame, position: str, by: list[str], width: int = SLAB) -> DataFrame:
    """Adds `row_no`, counted from 1 within each `by` group."""
    return running_offset(df, position, by, F.lit(1), "_before", width).withColumn(
        "row_no", F.col("_before") + 1
    ).drop("_before")
