"""Shared folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a temporary
    folder, made once and kept in the session's runtime configuration.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    own = spark.conf.get("tidemark.shared.dir", None)
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("tidemark.shared.dir", own)
    return own


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and gives
    Spark the true size of the table for its join planning.  Staged tables lie
    in one folder per application, to be removed after it has ended.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/staged/{app}/{label}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_store(root: str):
    """The Arrow file system of a root (path or URI), and the root's path on it."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def task_count(spark: SparkSession) -> int:
    """Tasks for work that is slow per row but small in bytes.

    Given as a number to ``repartition``, because Spark would otherwise merge
    such small partitions into one task.  The key has to differ from that of the
    step before (a hash of it will do): where both are the same, and so is the
    number, Spark leaves the second shuffle out and merges the first one's parts.
    """
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
