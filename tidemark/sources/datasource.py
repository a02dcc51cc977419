"""Folders as a Spark data source: ``spark.read.format("tidemark_folder")`` and ``df.write.format("tidemark_folder")``.

Reading lists files as metadata, lazily: nothing is opened before an action, and
filters on container and path reach the folders that are opened.  Writing puts
Parquet files under their names only when the whole job has succeeded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidemark.plans.storage import open_store
from tidemark.schema import INVENTORY

# Fixed value: the setting that lets filters reach a Python data source.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Folders to plan as partitions at least, where there are so many, and rows handed over at a time.
PARTITIONS, BATCH = 64, 10_000


@dataclass
class Folder(InputPartition):
    """A folder below a root; with ``deep`` all that is below it."""

    root: str
    folder: str
    deep: bool


class FolderReader(DataSourceReader):
    """Plans folders as partitions: upper levels are opened until there are enough, each of the rest is one task."""

    def __init__(self, roots: list[str], partitions: int, with_directories: bool):
        self.roots, self.wanted, self.with_directories = [r.rstrip("/") for r in roots], partitions, with_directories
        self.prefixes: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Note roots and path prefixes; Spark checks the rows itself as well."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("container",):
                values = f.value if isinstance(f, In) else [f.value]
                self.roots = [r for r in self.roots if r in values]
            elif isinstance(f, (EqualTo, StringStartsWith)) and f.attribute in (("full_path",), ("directory",)):
                self.prefixes.append(f.value)
            yield f

    def visits(self, folder: str) -> bool:
        """Whether files below a folder can have all prefixes."""
        return all(folder.startswith(p) or p.startswith(f"{folder}/") or p == folder or not folder for p in self.prefixes)

    def open(self, store, top: str, folder: str):
        """Entries of a folder and its subfolders to visit, or the error in place of them."""
        from pyarrow import fs

        try:
            infos = store.get_file_info(fs.FileSelector(f"{top}/{folder}" if folder else top or "/"))
        except OSError as e:
            if not folder:
                raise
            return None, [], str(e)
        below = [f"{folder}/{i.base_name}" if folder else i.base_name for i in infos if i.type == fs.FileType.Directory]
        return infos, [f for f in below if self.visits(f)], None

    def partitions(self) -> list[InputPartition]:
        out, level = [], [(root, "") for root in self.roots]
        while level and len(level) < self.wanted:
            following = []
            for root, folder in level:
                store, top = open_store(root)
                out.append(Folder(root, folder, False))
                following += [(root, f) for f in self.open(store, top, folder)[1]]
            level = following
        # A source without a partition cannot be planned; the first root's empty share stands for none.
        return out + [Folder(root, folder, True) for root, folder in level] or [Folder("", "", False)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        if not partition.root:
            return
        store, top = open_store(partition.root)
        todo = [partition.folder]
        while todo:
            folder = todo.pop()
            infos, below, error = self.open(store, top, folder)
            if error is not None:
                above, _, name = folder.rpartition("/")
                yield self._batch(partition.root, [(above, name, 0, None, True, error)])
                continue
            rows = ((folder, i.base_name, i.size if i.is_file else 0, i.mtime, not i.is_file, None)
                    for i in infos if i.is_file or self.with_directories)
            held = []
            for row in rows:
                held.append(row)
                if len(held) == BATCH:
                    yield self._batch(partition.root, held)
                    held = []
            if held:
                yield self._batch(partition.root, held)
            todo += below if partition.deep else []

    @staticmethod
    def _batch(root: str, rows: list[tuple]) -> pa.RecordBatch:
        directory, name, size, modified, is_directory, error = zip(*rows)
        text, none = pa.string(), [None] * len(rows)
        columns = {
            "provider": pa.array(["file"] * len(rows), text), "container": pa.array([root] * len(rows), text), "directory": pa.array(directory, text),
            "filename": pa.array(name, text), "full_path": pa.array([f"{d}/{n}" if d else n for d, n in zip(directory, name)], text),
            "size": pa.array(size, pa.int64()), "last_modified": pa.array(modified, pa.timestamp("us", "UTC")),
            "is_directory": pa.array(is_directory, pa.bool_()), "etag": pa.array(none, text),
            "extra": pa.array([[] if e is None else [("error.message", e)] for e in error], pa.map_(text, text))}
        return pa.RecordBatch.from_arrays([columns[f.name] for f in INVENTORY.fields], names=[f.name for f in INVENTORY.fields])


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class FolderWriter(DataSourceArrowWriter):
    """Tasks write below a folder of the job; its commit moves the files of the attempts that counted, its abort drops all."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyarrow import parquet

        store, top = open_store(self.path)
        store.create_dir(f"{top}/{self.job}", recursive=True)
        name, out = f"part-{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if out is None:
                    out = parquet.ParquetWriter(f"{top}/{self.job}/{name}", batch.schema, filesystem=store)
                out.write_batch(batch)
        finally:
            if out is not None:
                out.close()
        return Written([] if out is None else [name])

    def _data(self, store, top: str) -> list[str]:
        from pyarrow import fs

        infos = store.get_file_info(fs.FileSelector(top, allow_not_found=True))
        return [i.path for i in infos if i.is_file and i.base_name.startswith("part-")]

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, top = open_store(self.path)
        store.create_dir(top, recursive=True)
        old = self._data(store, top) if self.overwrite else []
        for name in [n for m in messages if m is not None for n in m.names]:
            store.move(f"{top}/{self.job}/{name}", f"{top}/{name}")
        for path in old:
            store.delete_file(path)
        with store.open_output_stream(f"{top}/_SUCCESS"):
            pass
        self._drop(store, top)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop(*open_store(self.path))

    def _drop(self, store, top: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{top}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{top}/{self.job}")


class FolderSource(DataSource):
    """Options: ``path`` or ``roots`` (JSON array of folders), ``partitions``, ``with_directories``."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_folder"

    def schema(self) -> StructType:
        return INVENTORY

    def _roots(self) -> list[str]:
        roots = json.loads(self.options["roots"]) if "roots" in self.options else [self.options.get("path")]
        if not all(roots):
            raise ValueError("give a path, or roots")
        return roots

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(self._roots(), int(self.options.get("partitions", PARTITIONS)),
                            self.options.get("with_directories", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        return FolderWriter(self._roots()[0], overwrite)


def register(spark: SparkSession) -> str:
    """Make the source known to a session, with filters reaching it unless the session says otherwise; its name."""
    spark.dataSource.register(FolderSource)
    if spark.conf.get(PUSHDOWN, "false") == "false":
        spark.conf.set(PUSHDOWN, "true")
    return FolderSource.name()
