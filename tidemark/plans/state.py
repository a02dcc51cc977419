"""Versioned state tables on any storage Spark can write to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class StateStore:
    """One folder per version; a version counts once its write has committed.

    The version is the batch id of the run that wrote it.  A retried batch
    reads the state from before itself and overwrites its own folder, so a
    retry gives the same result, and a reader never sees a half-written
    version or a folder that the same plan overwrites.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _path(self, version: int) -> str:
        return f"{self.root}/v={version:020d}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            path = status.getPath()
            name = path.getName()
            if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                found.append(int(name[2:]))
        return sorted(found)

    def latest(self, before: int | None = None) -> int | None:
        known = [v for v in self.versions() if before is None or v < before]
        return known[-1] if known else None

    def read(self, before: int | None = None) -> DataFrame:
        """Newest committed state older than ``before``; an empty table if there never was one.

        A run that is repeated after the state before it has been dropped would
        look like a first run, so that is an error.
        """
        version = self.latest(before)
        if version is None:
            first = self._first()
            if first is not None and (before is None or first < before):
                raise RuntimeError(f"the state before run {before} was dropped, so that run cannot be repeated")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._path(version))

    def write(self, state: DataFrame, version: int) -> DataFrame:
        state.write.mode("overwrite").parquet(self._path(version))
        return self.spark.read.schema(self.schema).parquet(self._path(version))

    def _first(self) -> int | None:
        """The first version there ever was, if it was dropped."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root))] if fs.exists(path(self.root)) else []
        return min((int(n[6:]) for n in names if n.startswith("first=")), default=None)

    def prune(self, keep: int = 2) -> None:
        """Drop versions older than the newest ``keep``, and note the first there ever was."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = self.versions()[:-keep]
        if old and self._first() is None:
            fs.create(path(f"{self.root}/first={old[0]}"), True).close()
        for version in old:
            fs.delete(path(self._path(version)), True)
