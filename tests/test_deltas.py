"""State as a log of changes: merges, repeats, bucketed bases, and what a run writes."""

import os

import pytest
from pyspark.sql import functions as F, types as T

from helpers import rows
from tidemark.plans.deltas import DeltaState
from tidemark.plans.joins import BroadcastLimit
from tidemark.streaming import EntityListing

SCHEMA = T.StructType([T.StructField("container", T.StringType()), T.StructField("key", T.StringType()), T.StructField("size", T.LongType())])


def state(spark, path, **more):
    return DeltaState(spark, str(path), SCHEMA, ["container", "key"], **more)


def made(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("compact_after", [1, 2, 100])
def test_versions_merge_to_the_newest_rows(spark, tmp_path, compact_after):
    log, want = state(spark, tmp_path / "s", compact_after=compact_after), {}
    assert rows(log.read()) == [] and log.latest() is None
    for v in range(1, 6):
        changed = {("a", f"k{k}"): v * 10 + k for k in range(v, v + 3)}
        log.write(made(spark, *[(*k, n) for k, n in changed.items()]), v)
        want |= changed
        assert rows(log.read()) == sorted(((*k, n) for k, n in want.items()), key=repr)
    assert rows(log.read(before=2)) == [("a", f"k{k}", 10 + k) for k in (1, 2, 3)]
    log.write(made(spark, ("a", "k4", 1)), 5)  # a repeated run overwrites its own version
    assert ("a", "k4", 1) in rows(log.read()) and ("a", "k5", 45) in rows(log.read())


@pytest.mark.parametrize("limit", [BroadcastLimit(), BroadcastLimit(0, 0)], ids=["broadcast", "shuffled"])
def test_compare_and_restart(spark, tmp_path, limit):
    log = state(spark, tmp_path / "s", compact_after=2)
    for v, n in ((1, 1), (2, 2), (3, 3)):
        log.write(made(spark, ("a", "x", n), ("a", f"v{n}", n)), v)
    assert any(name.startswith("base=") for name in os.listdir(tmp_path / "s"))
    df = made(spark, ("a", "x", 9), ("a", "v1", 9), ("b", "x", 9), ("a", "v3", None), (None, "x", 1))
    for again in (log, state(spark, tmp_path / "s")):
        out = again.compare(df, limit=limit)
        assert rows(out, "container", "key", "size", "_known", "_old_size") == sorted([
            ("a", "x", 9, True, 3), ("a", "v1", 9, True, 1), ("b", "x", 9, False, None), ("a", "v3", None, True, 3), (None, "x", 1, False, None)], key=repr)
    assert rows(log.compare(df, before=2), "key", "_known") == rows(df.select("key", F.expr("container = 'a' AND key IN ('x', 'v1')").alias("_known")).fillna(False))


def test_a_base_is_never_shuffled(spark, tmp_path):
    log = state(spark, tmp_path / "s", compact_after=1)
    log.write(spark.range(20_000).select(F.lit("a").alias("container"), F.col("id").cast("string").alias("key"), "id").toDF(*SCHEMA.names), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = log.compare(made(spark, ("a", "7", 1)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base = plan[plan.index("tidemark_base") - 2_000:plan.index("tidemark_base")]
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") <= 1 and "Bucketed: true" in plan, base


def test_compaction_drops_rows_and_pruning_keeps_what_is_read(spark, tmp_path):
    log = state(spark, tmp_path / "s", compact_after=3)
    for v in range(1, 10):
        log.write(made(spark, ("a", f"k{v}", v)), v, keep=F.col("size") > 4)
        log.prune(2)
    assert log.versions() == [8, 9] and rows(log.read(), "size") == [(n,) for n in range(5, 10)]
    assert rows(log.read(before=9), "size") == [(n,) for n in range(5, 9)]
    assert sorted(n.split("-")[0].lstrip("delta=bs0") for n in os.listdir(tmp_path / "s") if n[:5] in ("delta", "base=")) == ["6", "7", "8", "9", "9"]
    with pytest.raises(RuntimeError):
        log.read(before=8)


def files(spark, n, changed=-1):
    return spark.range(n).select(F.lit("a").alias("container"), F.concat(F.lit("some/folder/"), F.sha2(F.col("id").cast("string"), 256)).alias("full_path"),
                                 F.timestamp_millis(F.lit(10**9)).alias("last_modified"), F.when(F.col("id") % 100 == changed, 2).otherwise(1).cast("bigint").alias("size"))


def test_a_run_writes_what_changed(spark, tmp_path):
    """One per cent of the files changed: the run adds below five per cent of the state's bytes."""
    listing = EntityListing(spark, f"{tmp_path}/state", window_ms=10**9)
    assert listing.run(files(spark, 40_000), 1, f"{tmp_path}/out", 10**9).count() == 40_000
    whole = size_of(tmp_path / "state")
    assert listing.run(files(spark, 40_000, 7), 2, f"{tmp_path}/out", 10**9).count() == 400
    assert 0 < size_of(tmp_path / "state") - whole < 0.05 * whole
    assert listing.store.read().count() == 40_000 and listing.run(files(spark, 40_000, 7), 3, f"{tmp_path}/out", 10**9).count() == 0
