"""Sources of file metadata: directory scans and provider manifests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.paths import depth, join_path, parent
from tidemark.functions.values import merge_attributes
from tidemark.operators.predicates import FilterSpec
from tidemark.plans.storage import open_store, stage, task_count
from tidemark.schema import ATTRS, INVENTORY


_ENTRY = "directory string, filename string, size bigint, last_modified timestamp, is_directory boolean, error string"


def scan_inventory(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None,
                   provider: str = "file", with_directories: bool = False) -> DataFrame:
    """List what is under a root as metadata; content is never read.

    One Spark job per folder level, in which each folder is listed by a task
    and its entries go to the shared folder, so no listing passes through the
    driver.  Empty files and names that start with ``_`` or ``.`` are listed
    like any other (Spark's own file sources skip them), and names are joined as
    they are, blanks and doubled slashes included.  A folder below the root that
    cannot be listed, or is gone by then, gives a row of its own: a directory
    with ``error.message`` in ``extra``, returned also without
    ``with_directories``.  ``glob`` applies to file names.  Stores page through one folder in sequence; where a single
    folder holds more names than a task can, use ``read_manifest`` over the
    store's inventory report.
    """
    base = root.rstrip("/")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = open_store(base)
        names = ["directory", "filename", "size", "last_modified", "is_directory", "error"]
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                try:
                    infos = store.get_file_info(fs.FileSelector(f"{top}/{folder}" if folder else top or "/"))
                except OSError as e:
                    if not folder:
                        raise
                    above, _, name = folder.rpartition("/")
                    yield pa.RecordBatch.from_arrays([
                        pa.array([above]), pa.array([name]), pa.array([0], pa.int64()), pa.array([None], pa.timestamp("us", "UTC")),
                        pa.array([True]), pa.array([str(e)])], names=names)
                    continue
                for i in range(0, len(infos), 10_000):
                    part = infos[i:i + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([folder] * len(part), pa.string()),
                        pa.array([f.base_name for f in part], pa.string()),
                        pa.array([f.size if f.is_file else 0 for f in part], pa.int64()),
                        pa.array([f.mtime for f in part], pa.timestamp("us", "UTC")),
                        pa.array([f.type == fs.FileType.Directory for f in part], pa.bool_()),
                        pa.nulls(len(part), pa.string()),
                    ], names=names)

    path = F.when(F.col("directory") == "", F.col("filename")).otherwise(F.concat("directory", F.lit("/"), "filename"))
    level, levels = spark.createDataFrame([("",)], "folder string"), []
    while True:
        spread = level.repartition(task_count(spark), "folder")
        listed = stage(spread.mapInArrow(entries, _ENTRY), "scan")
        levels.append(listed)
        level = listed.where("is_directory AND error IS NULL").select(path.alias("folder"))
        if not recursive or level.isEmpty():
            break
    found = reduce(DataFrame.unionByName, levels)
    if not with_directories:
        found = found.where(~F.col("is_directory") | F.col("error").isNotNull())
    if glob:
        found = found.where(F.col("is_directory") | F.col("filename").rlike(rf"\A{_glob_pattern(glob)}\z"))
    return found.select(
        F.lit(provider).alias("provider"), F.lit(base).alias("container"), "directory", "filename",
        path.alias("full_path"), "size", "last_modified", "is_directory", F.lit(None).cast("string").alias("etag"),
        F.when(F.col("error").isNull(), F.create_map().cast(ATTRS))
        .otherwise(F.create_map(F.lit("error.message"), F.col("error"))).alias("extra"))


def _glob_pattern(glob: str) -> str:
    """Regular expression of a file name glob (``*``, ``?``)."""
    return re.sub(r"\\\*|\\\?", lambda m: ".*" if m.group() == r"\*" else ".", re.escape(glob))


# Column names of provider manifests, by inventory column.
MANIFEST_COLUMNS = {
    "sftp": {"container": "host", "directory": "path", "filename": "filename", "size": "size",
             "last_modified": "last_modified", "is_directory": "directory"},
    "smb": {"container": "service_location", "directory": "path", "filename": "name", "size": "size",
            "last_modified": "last_modified", "is_directory": "directory"},
    "s3": {"container": "bucket", "full_path": "key", "size": "size", "last_modified": "last_modified_ms",
           "etag": "etag"},
    "adls": {"container": "filesystem", "full_path": "file_path", "size": "length",
             "last_modified": "last_modified_ms", "is_directory": "is_directory", "etag": "etag"},
}


def read_manifest(df: DataFrame, provider: str, spec: FilterSpec | None = None,
                  now_ms: int | None = None) -> DataFrame:
    """Map a provider's own metadata table to the inventory.

    Columns without a place in the inventory go to ``extra`` as text (a map
    column named ``extra`` is merged in).  A pure projection, so filters on
    inventory columns still reach the scan of the manifest.  The exception are
    times kept as epoch milliseconds: give the ``spec`` of the listing to have
    its age and time bounds tested on the stored column too.
    """
    names = MANIFEST_COLUMNS[provider]
    raw = names["last_modified"]
    if spec is not None and raw.endswith("_ms"):
        for bound in spec.raw_time_bounds(F.col(raw), now_ms):
            df = df.where(bound)

    def source(column: str) -> Column | None:
        return F.col(names[column]) if column in names and names[column] in df.columns else None

    key = source("full_path")
    if key is not None:
        directory = F.coalesce(parent(key), F.lit(""))
        filename = F.substring_index(key, "/", -1)
        full_path = key
    else:
        directory, filename = source("directory"), source("filename")
        full_path = join_path(directory, filename)

    when = source("last_modified")
    if names["last_modified"].endswith("_ms"):
        when = F.timestamp_millis(when)
    is_directory = source("is_directory")
    etag = source("etag")
    spare = [c for c in df.columns if c not in names.values() and c != "extra"]
    pairs = [p for c in spare for p in (F.lit(c), F.col(c).cast("string"))]
    extra = F.create_map(*pairs).cast(ATTRS)
    if "extra" in df.columns:
        extra = merge_attributes(extra, F.col("extra"))
    return df.select(
        F.lit(provider).alias("provider"),
        source("container").alias("container"),
        directory.alias("directory"),
        filename.alias("filename"),
        full_path.alias("full_path"),
        source("size").cast("bigint").alias("size"),
        when.cast("timestamp").alias("last_modified"),
        (F.lit(False) if is_directory is None else is_directory).alias("is_directory"),
        (F.lit(None).cast("string") if etag is None else etag).alias("etag"),
        extra.alias("extra"),
    )


def union_providers(*inventories: DataFrame) -> DataFrame:
    """One inventory from many; columns a provider lacks are filled with null."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inventories)
    known = [c for c in INVENTORY.fieldNames() if c in merged.columns]
    return merged.select(*known, *[c for c in merged.columns if c not in known])


def scope(inv: DataFrame, container: str | None = None, directory: str | None = None,
          prefix: str | None = None, recursive: bool = True) -> DataFrame:
    """Restrict to a container and a directory (or a raw key prefix).

    ``recursive=False`` keeps direct children.  The conditions are plain
    equality and prefix tests: they prune partitions of a manifest partitioned
    by container and are pushed to its scan.
    """
    if container is not None:
        inv = inv.where(F.col("container") == container)
    if prefix:
        inv = inv.where(F.col("full_path").startswith(prefix))
        if not recursive:
            rest = F.substring(F.col("full_path"), len(prefix) + 1, 2_147_483_647)
            inv = inv.where(~rest.contains("/"))
    if directory is not None:
        d = directory.strip("/")
        here = F.col("directory") == d
        if not recursive:
            inv = inv.where(here)
        elif d:
            inv = inv.where(here | F.col("directory").startswith(d + "/"))
    elif not prefix and not recursive:
        inv = inv.where(depth(F.col("directory")) == 0)
    return inv


def any_object(inv: DataFrame, container: str, prefix: str | None = None) -> bool:
    """Preflight of one listing: reads at most one row.

    A null or empty prefix means the whole container; a blank one is a prefix.
    """
    return not scope(inv, container, prefix=prefix or None).select(F.lit(1)).limit(1).isEmpty()
