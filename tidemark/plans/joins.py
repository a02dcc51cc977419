"""Joins of a large table with a table that is usually, but not surely, small."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.storage import stage


@dataclass(frozen=True)
class BroadcastLimit:
    """What may be broadcast.  Both bounds are checked against the data."""

    rows: int = 200_000
    bytes: int = 32 * 1024 * 1024


DEFAULT_LIMIT = BroadcastLimit()

# A key with more rows than this is split, into as many parts as it needs.  Only if
# there are more than MAX_HOT_KEYS such keys does the bound rise, since they are broadcast.
HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 200_000
# Tasks that rows without a key are spread over.
NO_KEY_PARTS = 1_024
HASH_BUCKETS = 1 << 20


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: text and binary by length, nested values as JSON, the rest 8 bytes each."""
    total = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("map", "array", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total


def measure(small: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> bool:
    """Whether a table fits the broadcast limit.

    Reads at most ``limit.rows + 1`` rows and brings back one row.
    """
    n, size = (small.limit(limit.rows + 1)
               .agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(small)), F.lit(0))).first())
    return n <= limit.rows and size <= limit.bytes


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate.  Good for skipping a measurement, not for a broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(large: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys of a table with more than ``hot_rows`` rows, and into how many parts to split each.

    None when there are none, which for a table of no more rows than that costs
    a row count.  Otherwise rows are first counted per hash bucket, and only
    keys in crowded buckets are counted themselves, so the keys of the whole
    table are never shuffled.  The threshold rises with the table: there are
    never more than ``MAX_HOT_KEYS``, few enough to broadcast by construction.
    """
    if large.count() <= hot_rows:
        return None
    keyed = large.select(*on, F.pmod(F.xxhash64(*on), F.lit(HASH_BUCKETS)).alias("_bucket"))
    crowded = stage(keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
                    .where(F.col("_n") > hot_rows).select("_bucket"), "crowded")
    if crowded.isEmpty():
        return None
    counts = stage(keyed.join(F.broadcast(crowded), "_bucket", "left_semi").groupBy(*on)
                   .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows), "hot")
    total = counts.agg(F.sum("_n")).first()[0]
    if total is None:
        return None
    floor = max(hot_rows, total // MAX_HOT_KEYS)
    parts = F.ceil(F.col("_n") / floor).cast("int")
    return counts.where(F.col("_n") > floor).select(*on, parts.alias("_parts"))


def salted_join(large: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                residual: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Shuffle join that splits the hot keys of the large side over many tasks.

    Rows of a hot key get a salt from a hash of the row (the same when a task
    is retried); the rows of the small side with that key are repeated once per
    salt.  Rows without a key match nothing and are spread freely.  All other
    keys join as usual.  ``how`` may be any join that keeps rows of the large
    side only (inner, left, left_semi, left_anti).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} cannot be salted")
    hot = hot_keys(large, on, hot_rows)
    if hot is None:
        return _equi_join(large, small, on, how, residual)
    hashable = [f.name for f in large.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    spread = F.when(no_key, F.lit(NO_KEY_PARTS)).otherwise(F.coalesce("_parts", F.lit(1)))
    left = (large.join(F.broadcast(hot), on, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*hashable), spread).cast("int")).drop("_parts"))
    right = small.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return _equi_join(left, right, [*on, "_salt"], how, residual).drop("_salt").select(
        *_columns(large, small, on, how))


def _columns(large: DataFrame, small: DataFrame, on: list[str], how: str) -> list[str]:
    kept = [*on, *[c for c in large.columns if c not in on]]
    return kept if how in ("left_semi", "left_anti") else kept + [c for c in small.columns if c not in on]


def join_checked(large: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 residual: Column | None = None, limit: BroadcastLimit = DEFAULT_LIMIT,
                 fits: bool | None = None) -> DataFrame:
    """Broadcast the small side if it was measured to fit, else shuffle with its hot keys split.

    ``residual`` is a further condition over columns of both sides (their
    names, apart from ``on``, must differ).
    """
    if fits is None:
        fits = measure(small, limit)
    if fits:
        return _equi_join(large, F.broadcast(small), on, how, residual)
    return salted_join(large, small, on, how, residual)


def _equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str,
               residual: Column | None) -> DataFrame:
    if residual is None:
        return left.join(right, on, how)
    if how == "inner":
        return left.join(right, on, how).where(residual)
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = residual
    for c in on:
        cond = (F.col(c) == F.col(f"_r_{c}")) & cond
    out = left.join(renamed, cond, how)
    return out.drop(*[f"_r_{c}" for c in on])
