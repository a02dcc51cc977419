"""File content: reading what a listing names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.paths import normalise_path
from tidemark.functions.values import MISSING_FILE_CODE, UNKNOWN_ERROR_CODE
from tidemark.plans.joins import measure
from tidemark.plans.storage import open_store, task_count
from tidemark.schema import FAILURE, SUCCESS

_FETCHED = [T.StructField("content", T.BinaryType()), T.StructField("error_code", T.StringType()),
            T.StructField("error_message", T.StringType())]

# Content that one output batch holds at most, and the largest file that is returned as one value.
_BATCH_BYTES = 64 * 1024 * 1024
MAX_FILE_BYTES = 1024 * 1024 * 1024


def attach_content(listing: DataFrame, content: DataFrame) -> DataFrame:
    """Join a listing with a table of contents (``path``, ``content``) on normalised path.

    A listed file without content is a failure.  Of several contents for one
    path any one is taken.  Content that no listed path names is dropped before
    the shuffle if the listed paths were measured to fit a broadcast.  Both
    sides are keyed by path, so a container with most of the files is spread
    over all tasks.
    """
    keyed = listing.withColumn("_key", normalise_path(F.col("full_path"), relative=True))
    right = content.select(normalise_path(F.col("path"), relative=True).alias("_key"), F.col("content"),
                           F.lit(True).alias("_found"))
    wanted = keyed.select("_key").distinct()
    if measure(wanted):
        right = right.join(F.broadcast(wanted), "_key", "left_semi")
    joined = keyed.join(right.dropDuplicates(["_key"]).hint("shuffle_hash"), "_key", "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    return (joined
            .withColumn("route", F.when(found, SUCCESS).otherwise(FAILURE))
            .withColumn("error_code", F.when(~found, F.lit(str(MISSING_FILE_CODE))))
            .withColumn("error_message", F.when(~found, F.concat(F.lit("no such file: "), F.col("full_path"))))
            .drop("_key", "_found"))


def fetch_content(listing: DataFrame, root: str, partitions: int | None = None,
                  max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """``listing`` with ``content``, ``error_code``, ``error_message`` and ``route``.

    Reads each row's ``full_path`` below ``root``.  All columns and repeated rows
    stay.  Only listed files are opened, each in the task that holds its row, and
    the bytes are not shuffled.  Rows are spread by path, so one directory does
    not end in one task.  A file above ``max_bytes``, which must fit in a task's
    memory, is a failure of its row alone; ``fetch_chunks`` reads such files.
    """
    kept = listing.select([F.col(f"`{c}`") for c in listing.columns if c not in ("content", "error_code", "error_message", "route")])
    rows = kept.repartition(partitions or task_count(listing.sparkSession), F.xxhash64("full_path"))
    base, at = root.rstrip("/"), kept.columns.index("full_path")
    schema = T.StructType(kept.schema.fields + _FETCHED)

    def one(store, folder: str, path: str | None):
        try:
            name = f"{folder}/{(path or '').lstrip('/')}"
            size = store.get_file_info(name).size or 0
            if size > max_bytes:
                return None, UNKNOWN_ERROR_CODE, f"{path}: {size} bytes are too many for one value"
            with store.open_input_stream(name) as f:
                return f.read(), None, None
        except FileNotFoundError as e:
            return None, str(MISSING_FILE_CODE), str(e)
        except (OSError, MemoryError, pa.ArrowException) as e:
            code = str(e.errno) if getattr(e, "errno", None) else UNKNOWN_ERROR_CODE
            return None, code, str(e) or type(e).__name__

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(base)
        for batch in batches:
            done, held, first = [], 0, 0
            for number, path in enumerate(batch.column(at).to_pylist()):
                found = one(store, folder, path)
                size = len(found[0] or b"")
                if done and held + size > _BATCH_BYTES:
                    yield _with(batch.slice(first, len(done)), done, schema)
                    done, held, first = [], 0, number
                done.append(found)
                held += size
            if done:
                yield _with(batch.slice(first, len(done)), done, schema)

    fetched = rows.mapInArrow(read, schema)
    return fetched.withColumn("route", F.when(F.col("error_code").isNull(), SUCCESS).otherwise(FAILURE))


def _with(rows: pa.RecordBatch, found: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    added = [pa.array(list(column), type=kind) for column, kind in zip(zip(*found), (pa.binary(), pa.string(), pa.string()))]
    return pa.RecordBatch.from_arrays([*rows.columns, *added], names=schema.fieldNames())


def fetch_chunks(listing: DataFrame, root: str, chunk_bytes: int = _BATCH_BYTES, partitions: int | None = None) -> DataFrame:
    """The bytes of files of any size as ``full_path``, ``chunk_no`` (from 0) and ``content``, one row per chunk.

    An empty file has one empty chunk.  A file that cannot be read to its end
    closes with a row whose ``error_message`` says why and whose content is null.
    """
    rows = listing.select("full_path").distinct().repartition(partitions or task_count(listing.sparkSession), F.xxhash64("full_path"))
    base = root.rstrip("/")
    names = ["full_path", "chunk_no", "content", "error_message"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(base)

        def row(path, number, content, error):
            return pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([number], pa.int64()),
                                               pa.array([content], pa.binary()), pa.array([error], pa.string())], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                number = 0
                try:
                    with store.open_input_stream(f"{folder}/{(path or '').lstrip('/')}") as f:
                        while (chunk := f.read(chunk_bytes)) or number == 0:
                            yield row(path, number, chunk, None)
                            number += 1
                except (OSError, MemoryError, pa.ArrowException) as e:
                    yield row(path, number, None, str(e) or type(e).__name__)

    return rows.mapInArrow(read, "full_path string, chunk_no bigint, content binary, error_message string")
