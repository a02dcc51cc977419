"""State as a log of changes over a bucketed base, so that a run writes what changed and no more."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.plans.joins import DEFAULT_LIMIT, BroadcastLimit, measure

# Changes that are read on top of a base before they are merged into a new one.
COMPACT_AFTER = 8
# Rows of a bucket of a base.
BUCKET_ROWS = 2_000_000


class DeltaState:
    """Rows by key, in versions: each has the rows that one run changed; now and then a base has all of them.

    A version is the number of the run that wrote it and counts once its write
    has committed.  A repeated run reads what was before it and overwrites its
    own version.  Bases are bucketed by a hash of the key: a table that is
    compared with the state is brought to its buckets, and the base itself is
    never shuffled.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], compact_after: int = COMPACT_AFTER):
        self.spark, self.root, self.schema, self.keys, self.compact_after = spark, root.rstrip("/"), schema, keys, compact_after

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _committed(self, kind: str) -> dict[int, str]:
        """Folders of a kind (``delta``, ``base``) by version; a base's name ends with its number of buckets."""
        fs, path = self._files()
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root))] if fs.exists(path(self.root)) else []
        return {int(n.split("=")[1].split("-")[0]): f"{self.root}/{n}" for n in sorted(names)
                if n.startswith(f"{kind}=") and fs.exists(path(f"{self.root}/{n}/_SUCCESS"))}

    def versions(self) -> list[int]:
        """Versions whose state can be read, oldest first."""
        floor = self._mark("floor", max)
        return sorted(v for v in self._committed("delta") if floor is None or v >= floor)

    def latest(self, before: int | None = None) -> int | None:
        known = [v for v in self.versions() if before is None or v < before]
        return known[-1] if known else None

    def _mark(self, name: str, pick) -> int | None:
        """A number that was noted as an empty file: the first version there ever was, or the oldest that can be read."""
        fs, path = self._files()
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root))] if fs.exists(path(self.root)) else []
        return pick((int(n.split("=")[1]) for n in names if n.startswith(f"{name}=")), default=None)

    def _base(self, path: str) -> DataFrame:
        """A base as a bucketed table; the session's catalog only holds where it lies."""
        buckets = int(path.rsplit("-", 1)[1])
        name = f"tidemark_base_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def _parts(self, before: int | None) -> tuple[DataFrame | None, DataFrame | None, int]:
        """The newest base before a version, the newest row per key of the changes since, and the number of these versions."""
        upto = self.latest(before)
        if upto is None:
            first = self._mark("first", min)
            if first is not None and (before is None or first < before):
                raise RuntimeError(f"the state before run {before} was dropped, so that run cannot be repeated")
            return None, None, 0
        bases, deltas = ({v: p for v, p in self._committed(k).items() if v <= upto} for k in ("base", "delta"))
        start = max(bases, default=None)
        since = [p for v, p in deltas.items() if start is None or v > start]
        return (None if start is None else self._base(bases[start])), (self._newest(since) if since else None), len(since)

    def _newest(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(StructType(self.schema.fields + [StructField("_version", LongType())])).parquet(*paths)
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max(F.struct("_version", *rest)).alias("_row"))
        return newest.select(*[F.col(f"_row.{c}") if c in rest else F.col(c) for c in self.schema.fieldNames()])

    def read(self, before: int | None = None) -> DataFrame:
        """All rows as they were before a version."""
        base, changes, _ = self._parts(before)
        if base is None and changes is None:
            return self.spark.createDataFrame([], self.schema)
        if base is None or changes is None:
            return changes if base is None else base
        return base.join(changes.select(*self.keys), self.keys, "left_anti").unionByName(changes)

    def compare(self, df: DataFrame, before: int | None = None, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
        """``df`` with the state's other columns as ``_old_…`` and ``_known``; null where a key is not in it.

        Keys are rows' own, so none is hot.  The changes since the base are few
        and broadcast if they were measured to fit; of the base nothing moves.
        """
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        base, changes, _ = self._parts(before)
        out, found = df, []
        for name, part in (("_b", base), ("_c", changes)):
            if part is None:
                continue
            side = part.select(*self.keys, F.struct(*rest).alias(name))
            if name == "_c" and measure(changes, limit):
                side = F.broadcast(side)
            out, found = out.join(side, self.keys, "left"), [name, *found]
        row = F.coalesce(*found) if found else F.lit(None).cast(StructType([self.schema[c] for c in rest]))
        out = out.withColumn("_row", row)
        return out.select(*df.columns, F.col("_row").isNotNull().alias("_known"), *[F.col(f"_row.{c}").alias(f"_old_{c}") for c in rest])

    def write(self, changes: DataFrame, version: int, keep: Column | None = None) -> None:
        """Commit the rows that a run changed; merge them into a base if many versions have gathered.

        ``keep`` says which rows stay in a base.
        """
        fs, path = self._files()
        for v, folder in self._committed("base").items():
            if v >= version:  # holds what an earlier attempt of this run wrote
                fs.delete(path(folder), True)
        rows = changes.select(*self.schema.fieldNames(), F.lit(version).cast("bigint").alias("_version"))
        rows.write.mode("overwrite").parquet(f"{self.root}/delta={version:020d}")
        if self._parts(version + 1)[2] >= self.compact_after:
            self.compact(version, keep)

    def compact(self, version: int, keep: Column | None = None) -> None:
        whole = self.read(version + 1)
        whole = whole if keep is None else whole.where(keep)
        buckets = max(1, -(-whole.count() // BUCKET_ROWS))
        path = f"{self.root}/base={version:020d}-{buckets}"
        name = f"tidemark_base_{hashlib.md5(path.encode()).hexdigest()}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (whole.repartition(buckets, *self.keys).write.bucketBy(buckets, *self.keys).option("path", path)
         .mode("overwrite").format("parquet").saveAsTable(name))

    def prune(self, keep: int = 2) -> None:
        """Let only the newest ``keep`` versions be read, and drop the files that these do not need."""
        fs, path = self._files()
        kept, bases = self.versions()[-keep:], self._committed("base")
        if not kept:
            return
        old = [v for v in self._committed("delta") if v < kept[0]]
        if old:
            if self._mark("first", min) is None:
                fs.create(path(f"{self.root}/first={min(old)}"), True).close()
            before = self._mark("floor", max)
            fs.create(path(f"{self.root}/floor={kept[0]}"), True).close()
            if before is not None and before != kept[0]:
                fs.delete(path(f"{self.root}/floor={before}"), False)
        start = max((b for b in bases if b <= kept[0]), default=None)
        if start is not None:
            for v in old:
                if v <= start:
                    fs.delete(path(f"{self.root}/delta={v:020d}"), True)
            for v, folder in bases.items():
                if v < start:
                    fs.delete(path(folder), True)
