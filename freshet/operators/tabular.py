"""Table rows to chunks: a fixed number of rows per chunk, rendered as `column: value; ...` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.config import JobConfig
from freshet.functions.numbering import number_rows, slab_of


def chunk_rows(
    rows: DataFrame,
    columns: list[str],
    position: str,
    by: list[str] | None = None,
    config: JobConfig = JobConfig(),
) -> DataFrame:
    """One chunk per `rows_per_chunk` rows of each `by` group, in the order of the integer column `position`.

    Rows get dense numbers first (see `number_rows`), so each group collected here holds at most `rows_per_chunk`
    rows however large a table is.
    """
    by = by or []
    value = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    line = F.concat_ws("; ", *[F.concat(F.lit(f"{c}: "), value[c]) for c in columns])
    lines = number_rows(rows.select(*by, position, line.alias("_line")), position, by)
    per = config.rows_per_chunk
    ordinal = slab_of(F.col("row_no") - 1, per).cast("int")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("row_no", "_line"))), lambda s: s["_line"])
    return (
        lines.withColumn("ordinal", ordinal)
        .groupBy(*by, "ordinal")
        .agg(
            F.array_join(in_order, "\n").alias("text"),
            F.concat_ws("-", F.min("row_no").cast("string"), F.max("row_no").cast("string")).alias("rows"),
        )
        .withColumn("columns", F.array(*[F.lit(c) for c in columns]))
    )
