"""Incremental listing: what is new or changed since the stored state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.plans.joins import DEFAULT_LIMIT, BroadcastLimit, join_checked, measure
from tidemark.plans.storage import stage

TIMESTAMP_STATE = T.StructType([
    T.StructField("container", T.StringType()),
    T.StructField("newest", T.TimestampType()),
    T.StructField("key", T.StringType()),
])

ENTITY_STATE = T.StructType([
    T.StructField("container", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("size", T.LongType()),
])


def no_tracking(inv: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Every run emits all matches; there is no state."""
    return inv


def next_state(emitted: DataFrame, previous: DataFrame | None = None, by: str = "container",
               key: str = "full_path", limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Newest time per listing and, as rows, every key that shares it.

    Takes the rows a run emitted and the state before it, so that keys gather
    while the newest time stands still and a run without new files keeps the
    state.  The newest times (one row per listing) are staged; the join back to
    find the keys then broadcasts them if they were measured to fit.
    """
    rows = emitted.select(F.col(by), F.col("last_modified").alias("newest"), F.col(key).alias("key"))
    if previous is not None:
        rows = rows.unionByName(previous.select(by, "newest", "key"))
    newest = stage(rows.groupBy(by).agg(F.max("newest").alias("newest")), "newest")
    if measure(newest, limit):
        kept = rows.join(F.broadcast(newest), [by, "newest"], "left_semi")
    else:
        kept = rows.join(newest, [by, "newest"], "left_semi")
    return kept.distinct()


def new_since(inv: DataFrame, state: DataFrame, by: str = "container", key: str = "full_path",
              limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Files newer than the stored time, and files at that time whose key is not stored.

    The stored times are one row per listing; the key test is an anti-join on
    (listing, key, time), which a file that was rewritten later passes.  Files
    that arrive late with an older time are missed by design; ``track_entities``
    is the remedy.
    """
    times = state.groupBy(by).agg(F.max("newest").alias("_newest"))
    later = join_checked(inv, times, [by], "left", limit=limit)
    later = later.where(F.col("_newest").isNull() | (F.col("last_modified") >= F.col("_newest")))
    keys = state.select(F.col(by), F.col("newest").alias("last_modified"), F.col("key").alias(key)).distinct()
    if measure(keys, limit):
        keys = F.broadcast(keys)
    fresh = later.join(keys, [by, "last_modified", key], "left_anti")
    return fresh.select(*inv.columns)


def watermark_floor(state: DataFrame, by: str = "container") -> int | None:
    """Stored time (epoch ms) when the state holds a single listing, else none.

    One row comes back.  Used as a constant ``min_timestamp`` it reaches the
    scan of the inventory, so that files and row groups of old data are skipped.
    """
    n, floor = state.agg(F.count_distinct(by), F.min(F.unix_millis("newest"))).first()
    return floor if n == 1 else None


def changed_entities(inv: DataFrame, state: DataFrame, by: str = "container", key: str = "full_path",
                     limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Files that are not in the state, or differ from it in time or size.

    A file has a key of its own, so no key is hot; the state is broadcast if it
    was measured to fit.
    """
    old = state.select(F.col(by), F.col("key").alias(key), F.col("last_modified").alias("_old_last_modified"),
                       F.col("size").alias("_old_size"), F.lit(True).alias("_known"))
    joined = inv.join(F.broadcast(old) if measure(old, limit) else old, [by, key], "left")
    return entity_changes(joined, F.col("_known")).select(*inv.columns, "change")


def entity_changes(compared: DataFrame, known: Column) -> DataFrame:
    """Rows beside their old time and size (``_old_…``) that are new or changed, with ``change``."""
    same = (F.col("last_modified").eqNullSafe(F.col("_old_last_modified")) & F.col("size").eqNullSafe(F.col("_old_size")))
    change = F.when(~F.coalesce(known, F.lit(False)), "new").when(~same, "changed")
    return compared.withColumn("change", change).where(F.col("change").isNotNull())


def track_entities(inv: DataFrame, state: DataFrame, now_ms: int, window_ms: int,
                   initial_target: str = "all", first_run: bool = False,
                   by: str = "container", key: str = "full_path") -> tuple[DataFrame, DataFrame]:
    """Emit new or changed files inside the time window; returns (emitted, next state).

    A first run with ``initial_target="all"`` emits whatever there is, with
    ``"window"`` only what is inside the window.  State entries leave when they
    fall out of the window.  Tolerates files that arrive late.  Emitted rows and
    next state both come from joins on the file key, so no listing is a hot key.
    """
    floor = F.timestamp_millis(F.lit(now_ms - window_ms))
    recent = inv.where(F.col("last_modified") >= floor)
    seen = inv if first_run and initial_target == "all" else recent
    kept = state.where(F.col("last_modified") >= floor)
    emitted = changed_entities(seen, kept, by, key)
    current = recent.select(F.col(by), F.col(key).alias("key"), "last_modified", "size")
    gone = kept.select(by, "key", "last_modified", "size").join(current.select(by, "key"), [by, "key"], "left_anti")
    return emitted, current.unionByName(gone)


def initial_floor(strategy: str, state_empty: bool, tracking: str = "timestamps",
                  now_ms: int | None = None, timestamp_ms: int | None = None) -> int | None:
    """Floor of a first listing; applies only to timestamp tracking with empty state.

    ``all_files`` sets none, ``new_files`` starts now, ``from_timestamp`` at a
    given time.
    """
    if tracking != "timestamps" or not state_empty or strategy == "all_files":
        return None
    if strategy == "new_files":
        return now_ms
    if strategy == "from_timestamp":
        return timestamp_ms
    raise ValueError(f"unknown strategy {strategy!r}")


# Settings whose change drops the stored state, per provider.
RESET_SETTINGS = {
    "smb": ("service", "directory", "ignore_suffix"),
    "adls": ("credentials_service", "container", "directory", "recursive", "file_filter", "path_filter",
             "listing_strategy"),
}


def fingerprint(settings: dict[str, Column]) -> Column:
    """Hash of a listing's settings.  State is kept per fingerprint, so a changed
    setting finds no state and the listing starts afresh."""
    parts = []
    for name, value in settings.items():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.lit(f"{name}="), F.length(text).cast("string"), F.lit(":"), text),
                                F.lit(f"{name}=-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def surviving_state(state: DataFrame, current: DataFrame) -> DataFrame:
    """State rows whose fingerprint is still in use."""
    return join_checked(state, current.select("fingerprint").distinct(), ["fingerprint"], "left_semi")


def latest_per_path(snapshots: DataFrame, order: list[str], keys: list[str]) -> DataFrame:
    """Newest snapshot row per file.  Reduces on the map side, so a path with very
    many snapshots costs no more than one with few."""
    rest = [c for c in snapshots.columns if c not in keys]
    pick = F.max_by(F.struct(*rest), F.struct(*order))
    return snapshots.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*snapshots.columns)
