"""Write, directory and completion plans.  Pure: nothing is touched here.

The plans need metadata only.  Leave file content out of the request table (or
drop it before planning) and join it back by ``seq`` when publishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.paths import ancestors, depth, join_path, parent
from tidemark.plans.joins import HOT_ROWS, estimated_bytes, hot_keys, join_checked, measure
from tidemark.plans.ranking import running_number
from tidemark.schema import DEFAULT_BATCH_SIZE, FAILURE, SUCCESS

TARGET = ["host", "share"]

# Conflict settings.
REPLACE, IGNORE, FAIL = "replace", "ignore", "fail"


def with_destination(requests: DataFrame) -> DataFrame:
    """Add ``dest`` (full path) and ``dest_dir`` (its directory, null in the root)."""
    return (requests.withColumn("dest", join_path(F.col("directory"), F.col("filename")))
            .withColumn("dest_dir", parent(F.col("dest"))))


def assign_batches(requests: DataFrame, size: int = DEFAULT_BATCH_SIZE, by: list[str] | None = None,
                   order: list[str | Column] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``batch_no``: batches of one host and share, at most ``size`` requests each, in order."""
    numbered = running_number(requests, by or TARGET, order or ["seq"], "_rn", hot_rows)
    return numbered.withColumn("batch_no", F.ceil(F.col("_rn") / F.lit(size)).cast("bigint")).drop("_rn")


def next_batch(requests: DataFrame, size: int = DEFAULT_BATCH_SIZE, by: list[str] | None = None,
               order: list[str | Column] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First batch of each host and share.

    Up to 1,000 requests Spark cuts each task's rows to the first ``size`` per
    group before the shuffle, so a large group costs nothing extra; a larger
    batch is numbered like all others, with large groups split.
    """
    if size > 1_000:
        numbered = running_number(requests, by or TARGET, order or ["seq"], "_rn", hot_rows)
        return numbered.where(F.col("_rn") <= size).drop("_rn")
    w = Window.partitionBy(*(by or TARGET)).orderBy(*(order or ["seq"]))
    return requests.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= size).drop("_rn")


def resolve_conflicts(requests: DataFrame, existing: DataFrame, by: list[str] | None = None,
                      seq: str = "seq", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``target_exists`` as each request sees it when handled one by one in ``seq`` order.

    Only the first request for a target can find the name free; any later one
    meets the file of the first.  One shuffle by target brings requests and
    existing files together.  Targets with more than ``hot_rows`` rows do not
    take part in it: their first ``seq`` comes from an aggregation reduced on
    the map side, one row per target, and is broadcast.  When there are many
    more files than requests, and the requests were measured to fit a
    broadcast, files that no request names never leave their tasks.
    """
    keys = [*(by or TARGET), "dest"]
    wanted, taken = requests.select(*keys), existing.select(*keys)
    if estimated_bytes(taken) > 8 * estimated_bytes(wanted) and measure(wanted):
        taken = taken.join(F.broadcast(wanted), keys, "left_semi")
    hot = hot_keys(wanted.unionByName(taken), keys, hot_rows)
    if hot is None:
        return _first_come(requests, taken, keys, seq)
    hot = F.broadcast(hot.select(*keys))
    calm = _first_come(requests.join(hot, keys, "left_anti"), taken.join(hot, keys, "left_anti"), keys, seq)
    crowd = requests.join(hot, keys, "left_semi")
    firsts = _sightings(crowd.select(*keys, seq), taken.join(hot, keys, "left_semi")).groupBy(*keys).agg(
        F.min(seq).alias("_first"), F.bool_or("_file").alias("_taken"))
    crowd = crowd.join(F.broadcast(firsts), keys, "left")
    return calm.unionByName(crowd.withColumn("target_exists", F.col("_taken") | (F.col(seq) > F.col("_first")))
                            .drop("_first", "_taken"))


def _sightings(requests: DataFrame, taken: DataFrame) -> DataFrame:
    """Requests and existing files in one table, the files marked by ``_file``."""
    return requests.withColumn("_file", F.lit(False)).unionByName(
        taken.withColumn("_file", F.lit(True)), allowMissingColumns=True)


def _first_come(requests: DataFrame, taken: DataFrame, keys: list[str], seq: str) -> DataFrame:
    target = Window.partitionBy(*keys)
    exists = F.bool_or("_file").over(target) | (F.col(seq) > F.min(seq).over(target))
    return (_sightings(requests, taken).withColumn("target_exists", exists)
            .where(~F.col("_file")).drop("_file"))


def _action(exists: Column, conflict: Column) -> Column:
    return (F.when(~exists, "create")
            .when(conflict == IGNORE, "skip")
            .when(conflict == FAIL, "reject")
            .otherwise("overwrite"))


def plan_writes(requests: DataFrame, existing: DataFrame, existing_dirs: DataFrame | None = None,
                create_dirs: bool = False, batch_size: int | None = DEFAULT_BATCH_SIZE,
                by: list[str] | None = None, order: list[str | Column] | None = None,
                hot_rows: int = HOT_ROWS, seq: str = "seq") -> DataFrame:
    """Decide per request: create, overwrite, skip, reject or missing_directory.

    ``existing`` holds the files on the targets (``dest``), ``existing_dirs``
    the folders (``dest_dir``).  Without ``create_dirs`` a request into a folder
    that is not there fails; the root always exists.  Batches follow ``order``
    (default ``seq``); ``seq`` names the column, which may be a struct, that
    tells which of the requests for one target comes first.
    """
    by = by or TARGET
    plan = requests if "dest" in requests.columns else with_destination(requests)
    if batch_size is not None:
        plan = assign_batches(plan, batch_size, by, order, hot_rows)
    plan = resolve_conflicts(plan, existing, by, seq, hot_rows)
    action = _action(F.col("target_exists"), F.col("conflict"))
    if not create_dirs and existing_dirs is not None:
        there = existing_dirs.select(*by, "dest_dir").distinct().withColumn("_there", F.lit(True))
        plan = join_checked(plan, there, [*by, "dest_dir"], "left")
        in_root = F.col("dest_dir").isNull() | (F.col("dest_dir") == "/")
        action = F.when(~(in_root | F.coalesce("_there", F.lit(False))), "missing_directory").otherwise(action)
        plan = plan.withColumn("write_action", action).drop("_there")
    else:
        plan = plan.withColumn("write_action", action)
    return plan


def route_write(plan: DataFrame, failed_files: DataFrame | None = None,
                failed_batches: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Route of each planned write.

    ``failed_files`` (``seq``) are write or rename errors, ``failed_batches``
    (host, share, ``batch_no``) lost connections, which fail the whole batch.
    """
    by = by or TARGET
    good = F.col("write_action").isin("create", "overwrite", "skip")
    if failed_files is not None:
        bad = failed_files.select("seq").distinct().withColumn("_file_failed", F.lit(True))
        plan = plan.join(bad, "seq", "left")
        good = good & F.col("_file_failed").isNull()
    if failed_batches is not None:
        bad = failed_batches.select(*by, "batch_no").distinct().withColumn("_batch_failed", F.lit(True))
        plan = join_checked(plan, bad, [*by, "batch_no"], "left")
        good = good & F.col("_batch_failed").isNull()
    return plan.withColumn("route", F.when(good, SUCCESS).otherwise(FAILURE)).drop("_file_failed", "_batch_failed")


def effective_writes(plan: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Add ``is_effective``: the last create or overwrite of each target.

    Earlier ones are overwritten anyway, so only this one needs to be carried out.
    """
    keys = [*(by or TARGET), "dest"]
    writes = F.col("write_action").isin("create", "overwrite")
    last = plan.where(writes).groupBy(*keys).agg(F.max("seq").alias("seq"))
    return (plan.join(last.select("seq", F.lit(True).alias("_last")), "seq", "left")
            .withColumn("is_effective", F.coalesce("_last", F.lit(False))).drop("_last"))


def plan_directories(requests: DataFrame, existing_dirs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Every missing folder on the way to the requested files, once, with its ``depth``.

    Create them in order of depth.
    """
    by = by or TARGET
    plan = requests if "dest_dir" in requests.columns else with_destination(requests)
    wanted = plan.select(*by, "dest_dir").where(F.col("dest_dir").isNotNull()).distinct()
    folders = (wanted.select(*by, F.explode(ancestors(F.col("dest_dir"))).alias("dest_dir"))
               .where(F.col("dest_dir") != "/").distinct())
    missing = folders.join(existing_dirs.select(*by, "dest_dir").distinct(), [*by, "dest_dir"], "left_anti")
    return missing.withColumn("depth", depth(F.trim(F.col("dest_dir"), F.lit("/"))))


def plan_completion(fetched: DataFrame, strategy: str, destination: Column | None = None,
                    create_directory: bool = False) -> DataFrame:
    """What to do with each source file after its content has been committed.

    ``strategy`` is ``none``, ``move`` or ``delete``.  Only fetched files take
    part; a move keeps the file name and goes to ``destination``.
    """
    if strategy not in ("none", "move", "delete"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "move" and destination is None:
        raise ValueError("move needs a destination")
    act = F.col("route") == SUCCESS
    none = F.lit(None).cast("string")
    if strategy == "move":
        target = join_path(destination, F.col("filename"))
    else:
        target = none
    return (fetched
            .withColumn("completion", F.when(act, F.lit(strategy)).otherwise(F.lit("none")))
            .withColumn("move_to", F.when(act, target))
            .withColumn("ensure_directory", F.when(act & F.lit(strategy == "move" and create_directory),
                                                   none if destination is None else destination)))
