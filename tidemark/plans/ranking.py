"""Row numbers within groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.plans.joins import HOT_ROWS, hot_keys, measure
from tidemark.plans.storage import stage, task_count


def running_number(df: DataFrame, by: list[str], order: list[str | Column], out: str = "rn",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """``row_number() over (partition by … order by …)`` for groups of any size.

    Without groups of more than ``hot_rows`` rows this is that window.  Otherwise
    rows are range-partitioned by group and order, staged with the number of
    their range, numbered within (group, range) and moved up by the rows of the
    group in the ranges before.  Columns of any sortable type may lead, and rows
    that are equal in them are dealt out by a hash of the whole row, so their
    numbers do not depend on how tasks run.
    """
    hot = hot_keys(df, by, hot_rows)
    if hot is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
    parts = max(task_count(df.sparkSession), int(hot.agg(F.sum("_parts")).first()[0]) * 2)
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    sliced = stage(df.withColumn("_tie", F.xxhash64(*hashable)).repartitionByRange(parts, *by, *order, "_tie")
                   .withColumn("_slice", F.spark_partition_id()), "slices")
    part = [*by, "_slice"]
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    offsets = stage(counts.select(*[F.col(c).alias(f"_o_{c}") for c in part],
                                  F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets")
    if measure(offsets):
        offsets = F.broadcast(offsets)
    local = Window.partitionBy(*part).orderBy(*order, "_tie")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in part])
    return (sliced.withColumn(out, F.row_number().over(local).cast("bigint")).join(offsets, same)
            .withColumn(out, F.col(out) + F.col("_offset")).select(*df.columns, out))
