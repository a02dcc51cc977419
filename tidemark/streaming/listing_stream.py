"""Listing streams: triggers arrive as a stream, the inventory is a table.

The file source of Structured Streaming keys on the path and does not see a
file that is rewritten in place.  Listings must, hence the inventory is read as
a full snapshot in every batch and compared with a state table of our own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.incremental import (
    ENTITY_STATE, TIMESTAMP_STATE, entity_changes, fingerprint, initial_floor, new_since, next_state, track_entities, watermark_floor,
)
from tidemark.operators.listing import (
    ListingTemplates, SharedListings, emit_attributes, for_askers, match_listings, match_triggers, resolve_triggers, route_listing,
)
from tidemark.operators.predicates import FilterSpec, apply_filters, min_timestamp
from tidemark.plans.deltas import DeltaState
from tidemark.plans.joins import join_checked
from tidemark.plans.state import StateStore
from tidemark.plans.storage import stage
from tidemark.schema import DEFAULT_SCHEDULE, FAILURE, NO_FILES, SUCCESS
from tidemark.sources.sinks import read_listing_ids, write_listing, write_shared_listing


# Old states kept for runs that are repeated.
KEPT_STATES = 5


def schedule(interval: str | None = DEFAULT_SCHEDULE) -> dict:
    """Stream trigger: a timer, or everything there is now and stop."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def run_triggered_listing(triggers: DataFrame, inventory: Callable[[SparkSession], DataFrame],
                          templates: ListingTemplates, out: str, checkpoint: str,
                          spec: FilterSpec | None = None, clock_ms: Callable[[], int] | None = None,
                          listing: Column | None = None, records_requested: bool = True,
                          partition_by: tuple[str, ...] = ("trigger_id",),
                          trigger: dict | None = None, shared: bool = False) -> StreamingQuery:
    """List once per trigger of a stream; output is one folder per batch and route.

    ``inventory`` is called in each batch and gives the current snapshot.  The
    success rows are written first; the empty triggers are then found from what
    was written (one column), so the inventory is read once.  Batches are
    consumed once (checkpoint) and overwrite their own folders when retried.
    With very many triggers per batch give ``partition_by=()``: one folder per
    trigger is then too many.  With ``shared`` each different listing of a batch
    is written once, in a folder by ``listing``, and which trigger asked for it
    to ``askers/batch_id=…`` (``write_shared_listing``).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        resolved = stage(resolve_triggers(batch, templates), "triggers")
        now = clock_ms() if clock_ms else None
        match = match_listings if shared else match_triggers
        found = match(resolved, inventory(spark), templates, spec, now, with_attrs=listing is not None)
        rows = found.files if shared else found
        if listing is not None:
            rows = emit_attributes(rows, listing).drop("attrs")
        target = f"{out}/batch_id={batch_id}"
        if shared:
            stored = write_shared_listing(SharedListings(rows, found.askers), f"{target}/route={SUCCESS}",
                                          f"{out}/askers/batch_id={batch_id}", mode="overwrite")
        else:
            write_listing(rows, f"{target}/route={SUCCESS}", partition_by=partition_by, mode="overwrite")
        valid = resolved.where("is_valid").select("trigger_id")
        failed = resolved.where(~F.col("is_valid")).select("trigger_id", F.lit("invalid pattern").alias("error_message"))
        failed.write.mode("overwrite").parquet(f"{target}/route={FAILURE}")
        if records_requested:
            ids = (_askers_of(stored.files, stored.askers) if shared
                   else _written_ids(spark, f"{target}/route={SUCCESS}", bool(partition_by)))
            empty = valid if ids is None else valid.join(ids, "trigger_id", "left_anti")
            empty.write.mode("overwrite").parquet(f"{target}/route={NO_FILES}")

    return (triggers.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or schedule(None))).start())


def _askers_of(files: DataFrame, askers: DataFrame) -> DataFrame:
    """Triggers with at least one file in their listing."""
    return askers.join(files.select("listing").distinct(), "listing", "left_semi").select("trigger_id").distinct()


def _written_ids(spark: SparkSession, path: str, folders: bool) -> DataFrame | None:
    """Triggers of a written listing; none if it has no rows and so no trigger folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if folders and not any(s.isDirectory() for s in fs.listStatus(root)):
        return None
    return read_listing_ids(spark, path).select(F.col("trigger_id").cast("bigint").alias("trigger_id"))


@dataclass
class TimestampListing:
    """Incremental listing by newest time, with durable state per run number."""

    spark: SparkSession
    state_root: str
    by: str = "container"
    key: str = "full_path"

    def __post_init__(self) -> None:
        self.store = StateStore(self.spark, self.state_root, TIMESTAMP_STATE)

    def run(self, inv: DataFrame, version: int, out: str, spec: FilterSpec | None = None,
            now_ms: int | None = None, only: str | None = None) -> DataFrame:
        """List what is new, write it, and only then commit the state.

        A repeated version reads the state from before it and overwrites its
        own output and state.  ``only`` names the one listing this state is
        for; its stored time then reaches the scan as a constant, and files and
        row groups with nothing new are skipped.
        """
        state = self.store.read(before=version)
        if spec is not None:
            inv = apply_filters(inv, spec, now_ms)
        if only is not None:
            inv = inv.where(F.col(self.by) == only)
            floor = watermark_floor(state, self.by)
            if floor is not None:
                inv = inv.where(min_timestamp(floor))
        fresh = new_since(inv, state, self.by, self.key)
        target = f"{out}/run={version}"
        fresh.write.mode("overwrite").parquet(target)
        emitted = self.spark.read.schema(fresh.schema).parquet(target)
        self.store.write(next_state(emitted, state, self.by, self.key), version)
        self.store.prune(KEPT_STATES)
        return emitted


@dataclass
class EntityListing:
    """Incremental listing by file identity inside a time window, with durable state."""

    spark: SparkSession
    state_root: str
    window_ms: int
    initial_target: str = "all"
    by: str = "container"
    key: str = "full_path"

    def __post_init__(self) -> None:
        self.store = DeltaState(self.spark, self.state_root, ENTITY_STATE, ["container", "key"])

    def run(self, inv: DataFrame, version: int, out: str, now_ms: int) -> DataFrame:
        """List new and changed files, write them, and commit just these as the next version of the state.

        The snapshot is read once and compared with the state where it lies.
        """
        floor = F.timestamp_millis(F.lit(now_ms - self.window_ms))
        first = self.store.latest(before=version) is None
        seen = inv if first and self.initial_target == "all" else inv.where(F.col("last_modified") >= floor)
        named = seen.withColumns({"_by": F.col(self.by), "_key": F.col(self.key)})
        compared = self.store.compare(named.withColumnsRenamed({"container": "_own_container", "key": "_own_key"})
                                      .withColumnsRenamed({"_by": "container", "_key": "key"}), version)
        emitted = compared.drop("container", "key").withColumnsRenamed({"_own_container": "container", "_own_key": "key"})
        emitted = entity_changes(emitted, F.col("_known") & (F.col("_old_last_modified") >= floor)).select(*inv.columns, "change")
        target = f"{out}/run={version}"
        emitted.write.mode("overwrite").parquet(target)
        emitted = self.spark.read.schema(emitted.schema).parquet(target)
        entries = emitted.where(F.col("last_modified") >= floor).select(
            F.col(self.by).alias("container"), F.col(self.key).alias("key"), "last_modified", F.col("size").cast("bigint").alias("size"))
        self.store.write(entries, version, keep=F.col("last_modified") >= floor)
        self.store.prune(KEPT_STATES)
        return emitted


@dataclass
class TriggeredListing:
    """Listings asked for by triggers, each compared with the state of its own listing.

    A listing is a set of resolved settings, known by their fingerprint: equal
    triggers share its state, and a changed setting starts afresh.  ``tracking``
    is ``timestamps``, ``entities`` or ``none``.  ``target`` is a map over the
    resolved trigger's columns (``t_container``, ``t_prefix``, ``t_directory``).

    A listing is matched, compared and kept once, however many triggers ask for
    it.  With ``shared`` it is delivered once too: success rows then have their
    ``listing`` instead of a trigger, and ``askers`` tells whose it is.
    """

    spark: SparkSession
    state_root: str
    templates: ListingTemplates
    tracking: str = "timestamps"
    spec: FilterSpec | None = None
    target: Column | None = None
    initial: str = "all_files"
    initial_ms: int | None = None
    window_ms: int | None = None
    key: str = "full_path"
    shared: bool = False

    def __post_init__(self) -> None:
        if self.tracking not in ("timestamps", "entities", "none"):
            raise ValueError(f"unknown tracking {self.tracking!r}")
        kept = ENTITY_STATE if self.tracking == "entities" else TIMESTAMP_STATE
        self.store = StateStore(self.spark, self.state_root, StructType(
            [StructField("listing", StringType())] + [f for f in kept.fields if f.name != "container"]))

    def run(self, triggers: DataFrame, inv: DataFrame, version: int, out: str, now_ms: int | None = None,
            records_requested: bool = True) -> DataFrame:
        """Route the files that are new for each trigger, write them, and only then commit the state.

        Files of a listing without any state so far must pass the initial floor.
        Triggers, matches and new files are staged, so triggers are resolved and
        the inventory is read once.  A repeated version gives the same result.
        """
        state = self.store.read(before=version)
        names = ["t_container", "t_directory", "t_prefix", "t_file", "t_path"]
        resolved = stage(resolve_triggers(triggers, self.templates).withColumn(
            "listing", fingerprint({n: F.col(n) for n in names})), "triggers")
        found = match_listings(resolved, inv, self.templates, self.spec, now_ms)
        listed = found.files
        floor = initial_floor(self.initial, True, self.tracking, now_ms, self.initial_ms)
        if floor is not None:
            begun = state.select("listing").distinct().withColumn("_begun", F.lit(True))
            listed = join_checked(listed, begun, ["listing"], "left").where(
                F.col("_begun").isNotNull() | min_timestamp(floor)).drop("_begun")
        listed = stage(listed, "matches")
        if self.tracking == "timestamps":
            fresh = new_since(listed, state, "listing", self.key)
            following = None
        elif self.tracking == "entities":
            fresh, following = track_entities(listed, state, now_ms, self.window_ms, by="listing", key=self.key)
        else:
            fresh, following = listed, state
        fresh = stage(fresh, "fresh")
        failed = resolved.where(~F.col("is_valid")).select("trigger_id", F.lit("invalid pattern").alias("error_message"))
        # A trigger that came several times is met by each of its rows, as ever.
        own = resolved.where("is_valid").select("trigger_id", "listing", "attrs")
        askers = found.askers.join(own, ["trigger_id", "listing"]).join(failed, "trigger_id", "left_anti")
        files = listed.where(~F.col("is_directory")) if "is_directory" in listed.columns else listed
        hit = _askers_of(files, found.askers)
        if self.shared:
            emitted = fresh.join(askers.select("listing").distinct(), "listing", "left_semi").withColumn("trigger_id", F.lit(None).cast("bigint"))
        else:
            emitted = for_askers(fresh, askers)
        routed = route_listing(resolved, hit, emitted, failed, records_requested, self.target)
        path = f"{out}/run={version}"
        routed.write.mode("overwrite").parquet(path)
        if self.shared:
            askers.select("trigger_id", "listing").write.mode("overwrite").parquet(self._askers(out, version))
        if following is None:
            following = next_state(fresh, state, "listing", self.key)
        self.store.write(following.select(self.store.schema.fieldNames()).distinct(), version)
        self.store.prune(KEPT_STATES)
        return self.spark.read.schema(routed.schema).parquet(path)

    def _askers(self, out: str, version: int) -> str:
        return f"{out}/askers/run={version}"

    def askers(self, out: str, version: int) -> DataFrame:
        """Which ``trigger_id`` asked for which ``listing`` in a run with ``shared``."""
        return self.spark.read.parquet(self._askers(out, version))

    def counts(self, out: str, version: int, *by: Column) -> DataFrame:
        """Rows per ``trigger_id`` and ``route`` (and more) of a run with ``shared``; each listing is counted once."""
        rows, names = self.spark.read.parquet(f"{out}/run={version}"), ["route", *[f"_by{i}" for i in range(len(by))]]
        counted = rows.select("trigger_id", "listing", "route", *[c.alias(n) for c, n in zip(by, names[1:])]).groupBy(
            "trigger_id", "listing", *names).agg(F.count(F.lit(1)).alias("n"))
        delivered = counted.where(F.col("route") == SUCCESS).drop("trigger_id").join(self.askers(out, version), "listing")
        each = counted.where(F.col("route") != SUCCESS).unionByName(delivered)
        return each.groupBy("trigger_id", *names).agg(F.sum("n").alias("n"))


def run_incremental_triggers(triggers: DataFrame, inventory: Callable[[SparkSession], DataFrame], listing: TriggeredListing,
                             out: str, checkpoint: str, clock_ms: Callable[[], int] | None = None,
                             trigger: dict | None = None) -> StreamingQuery:
    """``TriggeredListing`` over a stream of triggers: one run per batch, numbered by the batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        listing.run(batch, inventory(batch.sparkSession), batch_id, out, clock_ms() if clock_ms else None)

    return (triggers.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or schedule(None))).start())


def run_scheduled_listing(spark: SparkSession, inventory: Callable[[SparkSession], DataFrame],
                          listing: Callable[[DataFrame, int], object], checkpoint: str,
                          interval: str = DEFAULT_SCHEDULE) -> StreamingQuery:
    """List on a timer, without any trigger: ``listing`` gets the current snapshot and the number of the run.

    Every interval brings one batch, whose id is the number; a batch that is
    repeated after a failure has the same number.
    """
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load())
    return (ticks.writeStream.foreachBatch(lambda batch, number: listing(inventory(batch.sparkSession), number) and None)
            .option("checkpointLocation", checkpoint).trigger(**schedule(interval)).start())
