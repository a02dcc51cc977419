"""Queries over incremental listing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.views import inventory, line_inventory, table, text
from tidemark.operators.incremental import (
    changed_entities, fingerprint, initial_floor, latest_per_path, new_since, next_state, no_tracking,
    surviving_state, track_entities,
)
from tidemark.operators.predicates import initial_timestamp
from tidemark.plans.storage import shared_dir, stage
from tidemark.streaming import EntityListing, TimestampListing, track_entities_stream
from tidemark.streaming.entity_stream import STATE_MEMORY, STATE_PROVIDER

_TIE = "1998-06-01"

_CYCLES = f"""WITH i AS (SELECT *, size < 25000 AS early FROM invl),
 c1 AS (SELECT * FROM i WHERE last_modified < TIMESTAMP '{_TIE}' OR (last_modified = TIMESTAMP '{_TIE}' AND early)),
 st AS (SELECT container, max(last_modified) AS wm FROM c1 GROUP BY 1),
 sk AS (SELECT DISTINCT c1.container, k, last_modified FROM c1 JOIN st USING (container) WHERE last_modified = wm),
 fresh AS (SELECT c2.* FROM i c2 LEFT JOIN st USING (container) WHERE wm IS NULL OR last_modified > wm
  OR (last_modified = wm AND NOT EXISTS (SELECT 1 FROM sk WHERE sk.container = c2.container AND sk.k = c2.k)))"""


def _first(inv: DataFrame) -> DataFrame:
    """The first cycle sees only part of the files at its newest instant."""
    tie = F.lit(_TIE).cast("timestamp")
    return inv.where((F.col("last_modified") < tie) | ((F.col("last_modified") == tie) & (F.col("size") < 25_000)))


@query("next_state", f"""{_CYCLES}, al AS (SELECT container, max(last_modified) AS wm FROM i GROUP BY 1)
 SELECT 1 AS cycle, container, epoch_ms(last_modified) AS newest_ms, k AS key FROM sk
 UNION ALL SELECT DISTINCT 2, i.container, epoch_ms(wm), k FROM i JOIN al ON al.container = i.container AND last_modified = wm""", ("invl",))
def _next_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a partial snapshot, and after the whole table."""
    inv = line_inventory(spark, sf_dir)
    one = stage(next_state(_first(inv), key="k"), "state")
    two = next_state(new_since(inv, one, key="k"), one, key="k")
    return one.select(F.lit(1).alias("cycle"), "container", F.unix_millis("newest").alias("newest_ms"), "key").unionByName(
        two.select(F.lit(2).alias("cycle"), "container", F.unix_millis("newest").alias("newest_ms"), "key"))


@query("new_since_timestamp", f"""{_CYCLES} SELECT container, count(*) AS n, epoch_ms(max(last_modified)) AS newest_ms FROM fresh GROUP BY 1""", ("invl",))
def _new_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cycles; the state goes through storage between them, as it does between runs."""
    inv = line_inventory(spark, sf_dir)
    state = stage(next_state(_first(inv), key="k"), "state")
    fresh = new_since(inv, state, key="k")
    return fresh.groupBy("container").agg(F.count(F.lit(1)).alias("n"), F.unix_millis(F.max("last_modified")).alias("newest_ms"))


@query("timestamp_listing_runs", f"""{_CYCLES} SELECT 1 AS run, container, count(*) AS n FROM c1 GROUP BY container
 UNION ALL SELECT 2, container, count(*) FROM fresh GROUP BY container""", ("invl",))
def _timestamp_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over durable state; the third finds nothing new."""
    path, inv = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}", line_inventory(spark, sf_dir)
    listing = TimestampListing(spark, f"{path}/state", key="k")
    runs = [listing.run(snapshot, n, f"{path}/out") for n, snapshot in
            enumerate((_first(inv), inv, inv), 1)]
    counted = [r.groupBy("container").agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("run"), "container", "n")
               for i, r in enumerate(runs, 1)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


_OLD = """old AS (SELECT container, k, CASE WHEN l_partkey % 5 = 0 THEN size + 1 ELSE size END AS size,
 CASE WHEN l_partkey % 7 = 0 THEN last_modified - INTERVAL 1 DAY ELSE last_modified END AS last_modified FROM invl WHERE l_suppkey % 3 <> 0)"""


def _old_entities(inv: DataFrame) -> DataFrame:
    """An earlier state: some files unknown, some of other size or time."""
    part = F.col("l_partkey")
    return inv.where(F.col("l_suppkey") % 3 != 0).select(
        "container", F.col("k").alias("key"),
        F.when(part % 7 == 0, F.col("last_modified") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("last_modified")).alias("last_modified"),
        F.when(part % 5 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"))


@query("changed_entities", f"""WITH {_OLD} SELECT container, change, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM (
 SELECT i.container, i.size, CASE WHEN o.k IS NULL THEN 'new' WHEN i.size IS DISTINCT FROM o.size
 OR i.last_modified IS DISTINCT FROM o.last_modified THEN 'changed' END AS change
 FROM invl i LEFT JOIN old o ON i.container = o.container AND i.k = o.k) x WHERE change IS NOT NULL GROUP BY 1, 2""", ("invl",))
def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = line_inventory(spark, sf_dir)
    rows = changed_entities(inv, _old_entities(inv), key="k")
    return rows.groupBy("container", "change").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


_WINDOW_FROM = "1997-01-01"
_WINDOW_MS, _WINDOW_NOW = 852_076_800_000, 1_704_153_600_000  # now minus window is 1997-01-01


@query("track_entities", f"""WITH {_OLD},
 recent AS (SELECT * FROM invl WHERE last_modified >= TIMESTAMP '{_WINDOW_FROM}'),
 kept AS (SELECT * FROM old WHERE last_modified >= TIMESTAMP '{_WINDOW_FROM}'),
 em AS (SELECT i.container FROM recent i LEFT JOIN kept o ON i.container = o.container AND i.k = o.k
  WHERE o.k IS NULL OR i.size IS DISTINCT FROM o.size OR i.last_modified IS DISTINCT FROM o.last_modified),
 nx AS (SELECT container, k FROM recent UNION SELECT container, k FROM kept)
 SELECT 'emitted' AS kind, container, count(*) AS n FROM em GROUP BY container
 UNION ALL SELECT 'state', container, count(*) FROM nx GROUP BY container""", ("invl",))
def _track(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = line_inventory(spark, sf_dir)
    emitted, state = track_entities(inv, _old_entities(inv), _WINDOW_NOW, _WINDOW_MS, key="k")
    parts = [df.groupBy("container").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "container", "n")
             for kind, df in (("emitted", emitted), ("state", state))]
    return parts[0].unionByName(parts[1])


@query("entity_listing_runs", f"""SELECT 1 AS run, container, count(*) AS n FROM invl WHERE l_suppkey % 3 <> 0 GROUP BY container
 UNION ALL SELECT 2, container, count(*) FROM invl WHERE last_modified >= TIMESTAMP '{_WINDOW_FROM}'
 AND (l_suppkey % 3 = 0 OR l_partkey % 5 = 0) GROUP BY container""", ("invl",))
def _entity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over durable state; in the second some files are new and some were rewritten."""
    path, inv = f"{shared_dir(spark)}/entities-{uuid.uuid4().hex}", line_inventory(spark, sf_dir)
    old = inv.where(F.col("l_suppkey") % 3 != 0).withColumn(
        "size", F.when(F.col("l_partkey") % 5 == 0, F.col("size") + 1).otherwise(F.col("size")))
    listing = EntityListing(spark, f"{path}/state", _WINDOW_MS, key="k")
    runs = [listing.run(snapshot, n, f"{path}/out", _WINDOW_NOW) for n, snapshot in enumerate((old, inv), 1)]
    counted = [r.groupBy("container").agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("run"), "container", "n")
               for i, r in enumerate(runs, 1)]
    return counted[0].unionByName(counted[1])


@query("entity_listing_stream", f"""SELECT 1 AS run, 'new' AS change, container, count(*) AS n FROM invl WHERE l_suppkey % 3 <> 0 GROUP BY container
 UNION ALL SELECT 2, CASE WHEN l_suppkey % 3 = 0 THEN 'new' ELSE 'changed' END AS change, container, count(*) FROM invl
 WHERE last_modified >= TIMESTAMP '{_WINDOW_FROM}' AND (l_suppkey % 3 = 0 OR l_partkey % 5 = 0) GROUP BY change, container""", ("invl",))
def _entity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of ``entity_listing_runs`` as a stream with its own state, restarted from its checkpoint between them."""
    path = f"{shared_dir(spark)}/entity-stream-{uuid.uuid4().hex}"
    inv = line_inventory(spark, sf_dir).select("container", "k", "last_modified", "size", "l_suppkey", "l_partkey")
    rewritten = F.when(F.col("l_partkey") % 5 == 0, F.col("size") + 1).otherwise(F.col("size"))
    first = inv.where(F.col("l_suppkey") % 3 != 0).withColumn("size", rewritten)
    unset = [name for name, _ in (STATE_PROVIDER, *STATE_MEMORY) if spark.conf.get(name, None) is None]
    for run, snapshot in enumerate((first, inv), 1):
        at = _WINDOW_NOW - 2 + run
        snapshot = snapshot.withColumn("listed_at", F.timestamp_millis(F.lit(at)))
        snapshot.write.mode("append").parquet(f"{path}/in")
        stream = track_entities_stream(spark.readStream.schema(snapshot.schema).parquet(f"{path}/in"), _WINDOW_MS,
                                       initial_ms=_WINDOW_NOW - 1, key="k", buckets=64)
        (stream.select((F.unix_millis("listed_at") - (_WINDOW_NOW - 2)).cast("int").alias("run"), "change", "container")
         .writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
         .trigger(once=True).start().awaitTermination())
    for name in unset:
        spark.conf.unset(name)  # the session is the caller's
    return spark.read.parquet(f"{path}/out").groupBy("run", "change", "container").agg(F.count(F.lit(1)).alias("n"))


@query("initial_listing", """SELECT 'from_timestamp' AS strategy, container, count(*) AS n FROM inv WHERE last_modified_ms >= 1704097200000 GROUP BY container
 UNION ALL SELECT 'all_files', container, count(*) FROM inv GROUP BY container
 UNION ALL SELECT 'new_files', container, count(*) FROM inv WHERE last_modified_ms >= 1704110000000 GROUP BY container""", ("inv",))
def _initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for strategy in ("from_timestamp", "all_files", "new_files"):
        inv = inventory(spark, sf_dir)
        floor = initial_floor(strategy, True, now_ms=1_704_110_000_000, timestamp_ms=1_704_097_200_000)
        kept = inv if floor is None else inv.where(initial_timestamp(floor))
        parts.append(kept.groupBy("container").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(strategy).alias("strategy"), "container", "n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("no_tracking", "SELECT container, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM inv GROUP BY container", ("inv",))
def _no_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = no_tracking(inventory(spark, sf_dir))
    return inv.groupBy("container").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


@query("reset_state", """SELECT o_orderkey, o_orderstatus, sha256(concat('service=', length(concat('s', o_custkey)), ':s', o_custkey, '|directory=',
 length(o_orderstatus), ':', o_orderstatus, '|ignore_suffix=', CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '4:.tmp' END)) AS fingerprint
 FROM orders WHERE o_orderstatus <> 'F'""")
def _reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows of listings whose directory setting changed are not found any more."""
    def settings(directory):
        return fingerprint({"service": F.concat(F.lit("s"), text("o_custkey")), "directory": directory,
                            "ignore_suffix": F.when(F.col("o_orderkey") % 2 != 0, ".tmp")})

    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    state = orders.select("o_orderkey", status, settings(status).alias("fingerprint"))
    current = orders.select(settings(F.when(status == "F", "moved").otherwise(status)).alias("fingerprint"))
    return surviving_state(state, current)


@query("latest_per_path", """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
 ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshots of (user, type); the last one counts."""
    snapshots = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return latest_per_path(snapshots, ["ts", "event_id"], ["user_id", "event_type"]).drop("ts")
