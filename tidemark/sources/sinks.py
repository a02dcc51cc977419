"""Sinks for listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.listing import SharedListings

# Mime types by output format.
MIME_TYPES = {"json": "application/json", "csv": "text/csv", "parquet": "application/parquet",
              "orc": "application/orc"}


def _writable(df: DataFrame, fmt: str) -> DataFrame:
    """Text formats hold no maps: these become JSON text."""
    maps = [f.name for f in df.schema.fields if f.dataType.typeName() == "map"] if fmt == "csv" else []
    return df.withColumns({c: F.to_json(c) for c in maps}) if maps else df


def write_listing(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("trigger_id",),
                  mode: str = "append") -> DataFrame:
    """Write whole listings as records, one folder per trigger.

    The rebalance hint gathers the rows of a trigger before the write and lets
    Spark split a trigger that holds most of the rows over many tasks, so there
    are neither thousands of tiny files nor one giant task.  In CSV, maps are
    JSON text.
    """
    df = _writable(df, fmt)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def write_shared_listing(shared: SharedListings, path: str, askers_path: str, fmt: str = "parquet", mode: str = "append") -> SharedListings:
    """Write each different listing once, one folder per listing, and beside them who asked for which.

    Equal triggers share their listing's folder, so what is written grows with
    the files that are listed and with the triggers, not with their product.
    """
    files = write_listing(shared.files, path, fmt, ("listing",), mode)
    return SharedListings(files, write_listing(shared.askers, askers_path, fmt, (), mode))


def write_manifest(inv: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Keep an inventory in folders by container, in the order of its paths; the inventory, read from there.

    A triggered listing over it opens only the folders of containers that some
    trigger asks for, if the resolved triggers are a table (``stage``): what
    checks their patterns counts as not repeatable, and Spark selects folders
    only by what it can ask for twice.  A container of any size is spread over
    many files.
    """
    (inv.hint("rebalance", F.col("container")).sortWithinPartitions("container", "full_path")
     .write.mode(mode).partitionBy("container").parquet(path))
    return read_manifest_folders(inv.sparkSession, path, inv.schema)


def read_manifest_folders(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An inventory that ``write_manifest`` keeps; containers are texts, whatever they look like."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def read_listing_ids(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Triggers that have at least one row in a written listing (reads one column)."""
    return spark.read.format(fmt).load(path).select("trigger_id").distinct()


def write_empty(spark: SparkSession, schema: StructType, path: str, fmt: str = "parquet") -> dict[str, str]:
    """Write a record set of zero rows that keeps its schema; returns its attributes."""
    _writable(spark.createDataFrame([], schema), fmt).coalesce(1).write.mode("overwrite").format(fmt).save(path)
    return {"record.count": "0", "mime.type": MIME_TYPES.get(fmt, "application/octet-stream")}
