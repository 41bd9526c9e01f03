"""Object stores and folders as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import text as tx
from freshet.functions.sizes import SLIM_ROWS, Kept, at_most, small_side
from freshet.operators.routing import select_markdown_files


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """Path relative to `root`, size and time of all files below it; contents are not read."""
    return _files(spark, root, suffixes).drop("content")


def _files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffixes:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().toString().rstrip("/")
    files = reader.load(root)
    plain = F.regexp_replace(F.col("path"), r"^(\w+):/+", "$1:/")
    prefix = F.length(F.regexp_replace(F.lit(base + "/"), r"^(\w+):/+", "$1:/"))
    return files.withColumn("path", F.substring(plain, prefix + 1, F.length(plain)))


def read_objects(spark: SparkSession, root: str, bucket: str, types: DataFrame | None = None) -> DataFrame:
    """Objects below `root` as (bucket, key, content_type, etag, size, body).

    The content type stored in `types` (key, content_type) wins; otherwise it is guessed from the name.
    """
    objects = _files(spark, root).select(
        F.lit(bucket).alias("bucket"), F.col("path").alias("key"), F.col("length").alias("size"), F.col("content").alias("body")
    )
    guessed = tx.guess_mime(F.col("key"), "application/octet-stream")
    if types is None:
        return objects.withColumn("content_type", guessed)
    stored = types.select("key", F.col("content_type").alias("_stored"))
    return (
        objects.join(stored, "key", "left").withColumn("content_type", F.coalesce("_stored", guessed)).drop("_stored")
    )


def markdown_tree(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """What uploading the markdown files of a repository would upload: path, key, content type; nothing is read."""
    return select_markdown_files(list_files(spark, root), prefix)


def fetch_bodies(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """References with the bodies of a table of objects. Objects that are gone give no row.

    For bodies that lie in a table. A folder of files would be read whole; use `fetch_objects` there.
    """
    wanted = refs.select("bucket", "key", "s3_uri", "etag")
    return objects.drop("etag", "s3_uri").join(small_side(wanted), ["bucket", "key"])


def named_objects(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """The rows of a table of objects that references name, as they are. Objects that are gone give no row.

    Bodies are not shuffled as long as the names that are wanted, or those that are not, are few.
    """
    names = ["bucket", "key"]
    wanted = refs.select(*names)
    if at_most(wanted, SLIM_ROWS):
        return objects.join(F.broadcast(wanted), names, "left_semi")
    named = objects.where("bucket is not null and key is not null")
    with Kept() as keep:
        others = keep(named.select(*names).distinct().join(wanted, names, "left_anti"))
        few, none = at_most(others, SLIM_ROWS), at_most(others, 0)
    if not few:
        return objects.join(wanted, names, "left_semi")
    return named if none else named.join(F.broadcast(others), names, "left_anti")


# Bytes of bodies that a task holds before it passes them on.
FETCH_BYTES = 64 << 20


def fetch_objects(refs: DataFrame, root: str = "s3://") -> DataFrame:
    """References with the bodies of their objects, each read by its own path `<root>/<bucket>/<key>`.

    Only the objects named are read, in parallel over the references. Objects that are gone come without a body, so
    that an ingest can report them as missing.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = root if root.endswith("/") else root + "/"
        filesystem, folder = fs.FileSystem.from_uri(base)

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        rows, held = [], 0
        for refs_batch in batches:
            for bucket, key, etag in zip(*(refs_batch.column(i).to_pylist() for i in range(3))):
                try:
                    with filesystem.open_input_stream("/".join(p for p in (folder.rstrip("/"), bucket, key) if p)) as f:
                        body = f.read()
                except FileNotFoundError:
                    body = None
                rows.append({"bucket": bucket, "key": key, "etag": etag, "body": body})
                held += len(body or b"")
                if held >= FETCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    schema = pa.schema([("bucket", pa.string()), ("key", pa.string()), ("etag", pa.string()), ("body", pa.binary())])
    bodies = refs.select("bucket", "key", "etag").mapInArrow(
        fetch, "bucket STRING, key STRING, etag STRING, body BINARY"
    )
    return bodies.withColumn("content_type", tx.guess_mime(F.col("key"), "application/octet-stream"))
