"""Counts over listings, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.operators.listing import trigger_counts
from tidemark.operators.predicates import FilterSpec, all_of
from tidemark.sources.sinks import write_listing

# Rules that come after the "unfiltered" count of the data-lake listing.
_PATTERN_RULES = ("file_filter", "path_filter")


def count_unfiltered(inv: DataFrame, spec: FilterSpec, now_ms: int, by: str = "container") -> DataFrame:
    """Files per container at three points of the filter chain, in one pass.

    ``unfiltered`` counts everything (what file shares report),
    ``before_patterns`` what is left before the regular expressions (what the
    data lake reports), ``filtered`` what passes all rules.
    """
    rules = spec.rules(now_ms)
    plain = all_of({k: v for k, v in rules.items() if k not in _PATTERN_RULES})
    return inv.groupBy(by).agg(
        F.count(F.lit(1)).alias("unfiltered"), F.count_if(plain).alias("before_patterns"),
        F.count_if(all_of(rules)).alias("filtered"))


def listing_summary(inv: DataFrame, spec: FilterSpec, now_ms: int, by: str = "container") -> DataFrame:
    """Files, bytes and newest time that pass, and how many each rule rejects on its own."""
    flags, counts = _flagged(inv, spec, now_ms)
    return flags.groupBy(by).agg(*counts)


def _flagged(inv: DataFrame, spec: FilterSpec, now_ms: int):
    """The inventory with a flag per rule (``_rule``), and the counts over it."""
    rules = spec.rules(now_ms)
    flags = inv.withColumns({f"_{name}": F.coalesce(rule, F.lit(False)) for name, rule in rules.items()})
    passed = all_of({name: F.col(f"_{name}") for name in rules})
    return flags, [
        F.count_if(passed).alias("files"),
        F.coalesce(F.sum(F.when(passed, F.col("size"))), F.lit(0)).alias("bytes"),
        F.max(F.when(passed, F.col("last_modified"))).alias("newest"),
        *[F.count_if(~F.col(f"_{name}")).alias(f"rejected_{name}") for name in rules]]


def write_counted_listing(inv: DataFrame, spec: FilterSpec, now_ms: int, path: str, fmt: str = "parquet",
                          mode: str = "overwrite") -> tuple[DataFrame, dict]:
    """Write the files of a listing, and count on the way; the rows written, and the counts.

    The counts are those of ``count_unfiltered`` and ``listing_summary`` over the
    whole inventory (``unfiltered``, ``before_patterns``, ``files``, ``bytes``,
    ``newest``, ``rejected_…``), observed while the rows pass to the files:
    nothing is listed or scanned a second time.  The write has no shuffle, so
    that a repeated task is not counted twice.
    """
    rules = spec.rules(now_ms)
    flags, counts = _flagged(inv, spec, now_ms)
    plain = all_of({name: F.col(f"_{name}") for name in rules if name not in _PATTERN_RULES})
    seen = Observation()
    observed = flags.observe(seen, F.count(F.lit(1)).alias("unfiltered"), F.count_if(plain).alias("before_patterns"), *counts)
    kept = observed.where(all_of({name: F.col(f"_{name}") for name in rules})).select(*[F.col(f"`{c}`") for c in inv.columns])
    return write_listing(kept, path, fmt, partition_by=(), mode=mode), seen.get


def record_count(triggers: DataFrame, matches: DataFrame) -> DataFrame:
    """Number of records each trigger's output holds, 0 included."""
    return trigger_counts(triggers, matches).select("trigger_id", "record_count")
