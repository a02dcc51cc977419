"""Message and trigger sources, as tables or as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schema import MESSAGES, TRIGGERS


def read_messages(df: DataFrame, remote_address: str | None = None) -> DataFrame:
    """Text frames with the address of their sender.

    ``df`` is any table or stream with a ``body`` (or ``value``) column; an
    ``remote_address`` given here is used where the rows carry none.
    """
    if "body" not in df.columns and "value" in df.columns:
        df = df.withColumnRenamed("value", "body")
    address = F.col("remote_address") if "remote_address" in df.columns else F.lit(None).cast("string")
    return df.withColumn("body", F.col("body").cast("string")) \
             .withColumn("remote_address", F.coalesce(address, F.lit(remote_address)))


def message_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of landed message files (JSON lines shaped like ``MESSAGES``)."""
    raw = (spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", max_files).json(path))
    return read_messages(raw)


def read_triggers(df: DataFrame, id_column: str = "trigger_id") -> DataFrame:
    """Listing requests: an id and a string map of everything else.

    Columns other than the id become attributes under their own name; null
    values are left out.  A table that already has ``attrs`` passes through.
    """
    if "attrs" in df.columns:
        return df.select(F.col(id_column).cast("bigint").alias("trigger_id"), "attrs")
    pairs = [p for c in df.columns if c != id_column for p in (F.lit(c), F.col(c).cast("string"))]
    attrs = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return df.select(F.col(id_column).cast("bigint").alias("trigger_id"), attrs.alias("attrs"))


def trigger_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of landed trigger files (JSON lines shaped like ``TRIGGERS``).

    Each trigger is consumed once: the checkpoint of the query remembers the
    files it has read.  No trigger, no listing.
    """
    return spark.readStream.schema(TRIGGERS).option("maxFilesPerTrigger", max_files).json(path)
