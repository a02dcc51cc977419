"""What the corpus operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tidemark.plans.joins import BroadcastLimit

#: Tables of ids, hashes and counts may be broadcast up to this size; it is measured each time.
SMALL = BroadcastLimit(rows=500_000, bytes=48 * 1024 * 1024)

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; plain ASCII values take the cheap way."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def two_hashes(c: Column) -> tuple[Column, Column]:
    """128 bits that stand for a value: two 64-bit hashes with different seeds."""
    return F.xxhash64(c), F.xxhash64(F.lit(7), c)


def without(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns of ``df`` except those that an operator sets itself."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


#: Text bytes that a Python task handles and returns at a time.
SLICE_BYTES = 4 * 1024 * 1024


def give_back() -> None:
    """Return freed memory to the system: Python processes stay for other tasks, which should not inherit it."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def add_from_text(df: DataFrame, added: str, start, text: str = "text") -> DataFrame:
    """``df`` with columns computed from its text column by Python tasks, Arrow batch by Arrow batch.

    ``added`` is the schema of the new columns as DDL; ``start()`` is called once
    per task and returns a function from a list of texts (None included) to one
    Arrow array or list per new column.  Other columns pass through untouched.
    """
    names = [f.name for f in StructType.fromDDL(added).fields]
    kept = df.select(*without(df, names))
    schema = StructType(kept.schema.fields + StructType.fromDDL(added).fields)
    kinds = [to_arrow_type(f.dataType) for f in StructType.fromDDL(added).fields]
    at = [c.lower() for c in kept.columns].index(text)
    # Arrow batches are bounded by rows only unless told otherwise; long texts need a bound in bytes.
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * SLICE_BYTES))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        work = start()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).cumsum()
            first = 0
            while first < batch.num_rows:
                upto = (int(sizes[first - 1]) if first else 0) + SLICE_BYTES
                last = max(first + 1, int(sizes.searchsorted(upto, side="right")))
                part = batch.slice(first, last - first)
                columns = [c if isinstance(c, pa.Array) else pa.array(c, kind)
                           for c, kind in zip(work(part.column(at).to_pylist()), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)
                first = last
        work = part = columns = batch = None
        give_back()

    return kept.mapInArrow(run, schema)
