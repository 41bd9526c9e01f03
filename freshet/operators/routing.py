"""Which extractor handles an object: by extension, else by MIME type, else plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.config import JobConfig
from freshet.functions import text as tx


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, key)


def extractor_name(key: Column, content_type: Column, config: JobConfig = JobConfig()) -> Column:
    return F.coalesce(
        _lookup(config.by_extension, tx.extension(key)),
        _lookup(config.by_mime, tx.bare_mime(content_type)),
        F.lit("text"),
    )


def route(objects: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    return objects.withColumn("extractor", extractor_name(F.col("key"), F.col("content_type"), config))


def identify(objects: DataFrame) -> DataFrame:
    """Stable document id from the URI, version from the raw body."""
    uri = tx.s3_uri(F.col("bucket"), F.col("key"))
    return objects.withColumns(
        {
            "source_uri": uri,
            "doc_id": tx.document_id(uri),
            "doc_content_hash": tx.content_hash(F.col("body").cast("binary")),
        }
    )


def select_markdown_files(files: DataFrame, prefix: str, default_mime: str = "text/markdown") -> DataFrame:
    """Files ending in .md or .mdx (any case) outside .git folders, with their object keys, sorted by path.

    `files` has a relative `path`. The sort is a range-partitioned one, as for any listing.
    """
    clean = prefix.strip("/")
    name = F.substring_index(F.col("path"), "/", -1)
    key = F.concat(F.lit(clean + "/"), F.col("path")) if clean else F.col("path")
    return (
        files.where(name.rlike(r"(?i).\.mdx?$"))
        .where(~F.array_contains(F.split("path", "/"), ".git"))
        .withColumn("key", key)
        .withColumn("content_type", tx.guess_mime(F.col("path"), default_mime))
        .orderBy("path")
    )
