"""Where a job may keep files that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles that are no longer used removed.

    Spark removes them once the driver's garbage collector has come across them, which a large heap puts off for long;
    the steps of a long job would pile up theirs on the executors' disks.
    """
    spark.sparkContext._jvm.System.gc()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for this run below the folder named by spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; a cluster must name a shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="freshet-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
