"""Listing by file identity as a stream: snapshots come in, files that are new or changed go out.

What was seen is kept in the stream's own state and lives as long as the time
window: Spark drops an entry that was not written for that long, and nothing
rewrites the state as a whole.  Files are grouped into buckets by a hash of
their key; a bucket's entries are read at once and compared with its rows, and
only changed entries are written.  A bucket's state is a log of blocks of
entries, of which the last one of a file counts: a block is one call to the
state store where an entry each would be thousands, and since all entries of a
block are written at one time, they share their lifetime.  A bucket with more
files than a task should hold is compared in pieces, which lie on the task's
disk until it is their turn.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

# The setting and the class that state with a lifetime needs.
STATE_PROVIDER = ("spark.sql.streaming.stateStore.providerClass",
                  "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
BUCKETS = 256
# Entries that are written to the state store at a time.
BLOCK = 10_000
# Rows and entries of a bucket that are compared at a time, and the parts that a larger bucket is put on disk in.
PIECE = 100_000
PARTS = 256
# Blocks that come from the state store at a time, and MB that one of its tables collects before they go to disk.
STATE_MEMORY = (("spark.sql.execution.arrow.transformWithStateInPySpark.maxStateRecordsPerBatch", "10"),
                ("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "16"))
_BLOCK_SCHEMA = "listings array<string>, keys array<string>, modified array<bigint>, sizes array<bigint>"


def needs_rocksdb(spark: SparkSession) -> None:
    """Set the state store of streams started from now on and bound its memory, as far as the session has not set them."""
    if "RocksDB" not in spark.conf.get(*STATE_PROVIDER):
        raise ValueError(f"{STATE_PROVIDER[0]} must be {STATE_PROVIDER[1]}")
    spark.conf.set(*STATE_PROVIDER)
    for name, value in STATE_MEMORY:
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def _names(texts: Any) -> Any:
    """Texts as Python objects, with None for those that are missing."""
    return texts.astype(object).where(texts.notna(), None)


def _entries(blocks: list) -> Any:
    """Numbered blocks of the log as a table."""
    import pandas as pd

    names = ("_name_by", "_name_key", "_old_modified", "_old_size")
    table = pd.DataFrame({name: [v for _, block in blocks for v in block[i]] for i, name in enumerate(names)}, dtype=object)
    return table.astype({"_old_modified": "Int64", "_old_size": "Int64"}).assign(
        _number=[n for (n,), block in blocks for _ in block[0]])


class _Parts:
    """Tables of files, kept until they grow large and then put on disk in parts by a hash of the file."""

    def __init__(self, by: str, key: str):
        self.by, self.key, self.kept, self.rows, self.sizes = by, key, [], 0, [0] * PARTS
        self.places: list[list[int]] = [[] for _ in range(PARTS)]
        self.file: Any = None

    def add(self, table: Any) -> None:
        self.kept.append(table)
        self.rows += len(table)
        if self.rows >= PIECE:
            self.put()

    def put(self) -> None:
        """What is kept goes to disk; the file has no name, so that nothing of it outlives the task."""
        import numpy as np
        import pandas as pd

        self.file = self.file or tempfile.TemporaryFile()
        if not self.rows:
            return
        table, self.kept, self.rows = pd.concat(self.kept, ignore_index=True), [], 0
        hashes = [pd.util.hash_array(_names(table[c]).to_numpy()) for c in (self.by, self.key)]
        parts = (hashes[0] * np.uint64(31) + hashes[1]) % np.uint64(PARTS)
        order = np.argsort(parts, kind="stable")
        bounds = np.searchsorted(parts[order], np.arange(PARTS + 1, dtype=np.uint64))
        for part in range(PARTS):
            if places := order[bounds[part]:bounds[part + 1]].tolist():
                self.places[part].append(self.file.tell())
                self.sizes[part] += len(places)
                pickle.dump(table.iloc[places], self.file, protocol=5)

    def get(self, parts: range) -> list:
        """Tables of these parts, in the order in which they were added."""
        found = []
        for place in [p for part in parts for p in self.places[part]]:
            self.file.seek(place)
            found.append(pickle.load(self.file))
        return found


def _pieces(batch: _Parts, log: _Parts) -> Iterator[tuple[Any, Any]]:
    """Rows of a batch with the entries of their files: all at once, or as many parts at a time as make a piece."""
    import pandas as pd

    if batch.file is None and log.file is None:
        yield pd.concat(batch.kept, ignore_index=True), pd.concat(log.kept, ignore_index=True)
        return
    batch.put()
    log.put()
    first = 0
    while first < PARTS:
        end, rows = first + 1, batch.sizes[first] + log.sizes[first]
        while end < PARTS and rows + batch.sizes[end] + log.sizes[end] <= PIECE:
            rows += batch.sizes[end] + log.sizes[end]
            end += 1
        parts, first = range(first, end), end
        if found := batch.get(parts):
            yield pd.concat(found, ignore_index=True), pd.concat(log.get(parts) or [_entries([])], ignore_index=True)


class _Seen(StatefulProcessor):
    """The newest (time, size) of every file of a bucket."""

    def __init__(self, columns: list[str], by: str, key: str, window_ms: int, initial_ms: int | None):
        self.columns, self.by, self.key, self.window_ms, self.initial_ms = columns, by, key, window_ms, initial_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.log = handle.getMapState("log", "number bigint", _BLOCK_SCHEMA, self.window_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
        import pandas as pd

        batch, log, blocks, entries, last = _Parts(self.by, self.key), _Parts("_name_by", "_name_key"), [], 0, -1
        for frame in rows:
            frame.columns = self.columns  # Spark hands over names with leading underscores as numbers
            batch.add(frame)
        for block in self.log.iterator() if self.log.exists() else ():
            last, entries = max(last, block[0][0]), entries + len(block[1][0])
            blocks.append(block)
            if entries >= BLOCK:
                log.add(_entries(blocks))
                blocks, entries = [], 0
        log.add(_entries(blocks))
        for whole, known in _pieces(batch, log):
            picked, written = self._compared(whole, known)
            for last, start in enumerate(range(0, len(written), BLOCK), last + 1):
                block = written.iloc[start:start + BLOCK]
                self.log.updateValue((last,), tuple([None if pd.isna(v) else v for v in block[c].tolist()] for c in written.columns))
            if picked is not None:
                yield picked

    def _compared(self, whole: Any, entries: Any) -> tuple[Any, Any]:
        """Rows to list, if any, and the entries to write, from all rows and entries of some files."""
        import pandas as pd

        batch = whole.sort_values(["_listed", "_modified"], kind="stable", ignore_index=True)
        known = entries.sort_values("_number", kind="stable").drop(columns="_number").drop_duplicates(["_name_by", "_name_key"], keep="last")
        now = pd.DataFrame({"_name_by": _names(batch[self.by]), "_name_key": _names(batch[self.key]),
                            "_modified": batch["_modified"].astype("int64"), "_size": batch["_size"].astype("Int64")})
        seen = now.merge(known, "left", ["_name_by", "_name_key"])  # one row each, in the order of the batch
        inside = batch["_modified"] >= batch["_listed"] - self.window_ms
        listed = inside | (batch["_listed"] <= self.initial_ms) if self.initial_ms is not None else inside
        is_known = seen["_old_modified"].notna()
        same = (seen["_modified"] == seen["_old_modified"]).fillna(False) & (
            (seen["_size"] == seen["_old_size"]).fillna(False) | (seen["_size"].isna() & seen["_old_size"].isna()))
        change = pd.Series("changed", index=batch.index, dtype=object).where(is_known, "new").where(listed & ~(is_known & same))
        for _, places in now[now.duplicated(["_name_by", "_name_key"], keep=False)].groupby(["_name_by", "_name_key"], dropna=False).groups.items():
            self._one_by_one(seen, places, inside, listed, change)
        written = now[inside & change.notna()].drop_duplicates(["_name_by", "_name_key"], keep="last")
        if change.notna().any():
            picked = batch[change.notna()].drop(columns=["_listed", "_modified", "_size", "_bucket"])
            picked = picked.assign(change=change.dropna())
            return picked.astype({c: object for c in picked if pd.api.types.is_string_dtype(picked[c])}), written
        return None, written

    @staticmethod
    def _one_by_one(seen: Any, places: Any, inside: Any, listed: Any, change: Any) -> None:
        """Changes of a file that a batch holds more than once: each row is compared with the one before."""
        import pandas as pd

        def pair(i: int, modified: str, size: str) -> tuple:
            return tuple(None if pd.isna(v) else int(v) for v in (seen.at[i, modified], seen.at[i, size]))

        before = pair(places[0], "_old_modified", "_old_size")
        known = before[0] is not None
        for i in places:
            now = pair(i, "_modified", "_size")
            change.at[i] = None if not listed[i] or (known and before == now) else "changed" if known else "new"
            if inside[i]:
                before, known = now, True

    def close(self) -> None:
        pass


def track_entities_stream(snapshots: DataFrame, window_ms: int, initial_ms: int | None = None, by: str = "container",
                          key: str = "full_path", listed_at: str = "listed_at", buckets: int = BUCKETS) -> DataFrame:
    """Rows of a stream of snapshots that are new, or differ in time or size from what was last listed, with ``change``.

    ``listed_at`` says when a row's snapshot was taken; rows older than
    ``window_ms`` at that time are not listed, unless their snapshot was taken
    up to ``initial_ms``.  Rows come in any order within a batch and are
    compared in the order of their snapshots.  An entry that was not written for
    ``window_ms`` of wall clock time is forgotten; by then its file is outside
    the window.  Run it on a timer or once per start: entries with a lifetime make
    Spark look at the state again and again, so "all there is now" never ends.
    More ``buckets`` mean fewer files in each; their number must not
    change while a checkpoint is in use.  A task holds ``PIECE`` rows of a bucket at a time,
    unless more belong to one file, and has the others of the bucket on its disk.  Checkpoints from before the log of
    blocks hold another state and must be begun anew.
    """
    needs_rocksdb(snapshots.sparkSession)
    keyed = snapshots.where(F.col(key).isNotNull() & F.col("last_modified").isNotNull()).withColumns({
        "_bucket": F.pmod(F.xxhash64(by, key), F.lit(buckets)).cast("int"),
        "_listed": F.unix_millis(listed_at), "_modified": F.unix_millis("last_modified"), "_size": F.col("size").cast("bigint")})
    out = StructType(snapshots.schema.fields + [StructField("change", StringType())])
    return keyed.groupBy("_bucket").transformWithStateInPandas(
        _Seen(keyed.columns, by, key, window_ms, initial_ms), out, outputMode="Append", timeMode="ProcessingTime")
