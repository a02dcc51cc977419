import random

import pytest
from helpers import rows
from pyspark.sql import Window, functions as F

from tidemark.operators.incremental import (
    ENTITY_STATE, TIMESTAMP_STATE, changed_entities, fingerprint, initial_floor, latest_per_path, new_since, next_state,
    surviving_state, track_entities, watermark_floor,
)
from tidemark.plans.joins import BroadcastLimit
from tidemark.plans.state import StateStore
from tidemark.streaming import EntityListing, TimestampListing


def inv(spark, *data):
    """(container, path, minute, size) rows."""
    df = spark.createDataFrame(list(data), "container string, full_path string, minute bigint, size bigint")
    return df.select("container", "full_path", F.timestamp_seconds(F.col("minute") * 60).alias("last_modified"), "size")


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_first_cycle_emits_all(spark):
    files = inv(spark, ("a", "x", 1, 1), ("b", "y", 2, 1))
    assert new_since(files, empty(spark, TIMESTAMP_STATE)).count() == 2


def test_ties_at_the_newest_time(spark):
    first = inv(spark, ("a", "x", 5, 1), ("a", "y", 3, 1), ("b", "p", 9, 1))
    state = next_state(first)
    assert rows(state, "container", "key") == [("a", "x"), ("b", "p")]
    second = inv(spark, ("a", "x", 5, 1), ("a", "y", 3, 1), ("a", "tie", 5, 1), ("a", "late", 4, 1), ("a", "new", 6, 1),
                 ("b", "p", 10, 1), ("c", "q", 1, 1))
    fresh = new_since(second, state)
    # late (older than the newest) is missed by design; p was rewritten; c is a listing without state
    assert rows(fresh, "container", "full_path") == [("a", "new"), ("a", "tie"), ("b", "p"), ("c", "q")]
    following = next_state(fresh, state)
    assert rows(following, "container", "key") == [("a", "new"), ("b", "p"), ("c", "q")]


def test_keys_gather_while_the_time_stands_still(spark):
    state = next_state(inv(spark, ("a", "x", 5, 1)))
    fresh = new_since(inv(spark, ("a", "x", 5, 1), ("a", "tie", 5, 1)), state)
    state = next_state(fresh, state)
    assert rows(state, "key") == [("tie",), ("x",)]
    nothing = new_since(inv(spark, ("a", "x", 5, 1), ("a", "tie", 5, 1)), state)
    assert nothing.count() == 0
    assert rows(next_state(nothing, state), "key") == [("tie",), ("x",)]  # a run without news keeps the state


@pytest.mark.parametrize("seed, limit", [(1, BroadcastLimit()), (2, BroadcastLimit(0, 0))])
def test_cycles_by_brute_force(spark, seed, limit):
    rnd = random.Random(seed)
    state, known = empty(spark, TIMESTAMP_STATE), {}
    snapshot = {}
    for cycle in range(3):
        for _ in range(25):
            snapshot[("hot" if rnd.random() < 0.5 else rnd.choice("ab"), f"f{rnd.randint(0, 40)}")] = rnd.randint(cycle * 4, cycle * 4 + 6)
        want = []
        for (c, k), t in snapshot.items():
            newest, keys = known.get(c, (None, set()))
            if newest is None or t > newest or (t == newest and k not in keys):
                want.append((c, k))
        for c, k in want:
            t = snapshot[(c, k)]
            newest, keys = known.get(c, (None, set()))
            if newest is None or t > newest:
                known[c] = (t, {k})
            elif t == newest:
                known[c] = (t, keys | {k})
        fresh = new_since(inv(spark, *[(c, k, t, 1) for (c, k), t in snapshot.items()]), state, limit=limit)
        assert rows(fresh, "container", "full_path") == sorted(want, key=repr)
        state = next_state(fresh, state, limit=limit)
        assert rows(state, "container", "key") == sorted(((c, k) for c, (_, ks) in known.items() for k in ks), key=repr)


def test_watermark_floor(spark):
    assert watermark_floor(next_state(inv(spark, ("a", "x", 5, 1)))) == 300_000
    assert watermark_floor(next_state(inv(spark, ("a", "x", 5, 1), ("b", "x", 5, 1)))) is None
    assert watermark_floor(empty(spark, TIMESTAMP_STATE)) is None


def entities(spark, *data):
    return inv(spark, *data).withColumnRenamed("full_path", "key")


def test_changed_entities(spark):
    state = entities(spark, ("a", "same", 1, 1), ("a", "size", 1, 1), ("a", "older", 5, 1), ("a", "newer", 1, 1), ("a", "null", 1, None))
    now = inv(spark, ("a", "same", 1, 1), ("a", "size", 1, 2), ("a", "older", 4, 1), ("a", "newer", 2, 1), ("b", "same", 1, 1),
              ("a", "null", 1, None))
    assert rows(changed_entities(now, state), "container", "full_path", "change") == [
        ("a", "newer", "changed"), ("a", "older", "changed"), ("a", "size", "changed"), ("b", "same", "new")]


def test_entity_window(spark):
    now, window = 100 * 60_000, 50 * 60_000  # floor is minute 50
    state = entities(spark, ("a", "evicted", 10, 1), ("a", "gone", 60, 1), ("a", "same", 60, 1))
    files = inv(spark, ("a", "old", 49, 1), ("a", "edge", 50, 1), ("a", "same", 60, 1), ("a", "evicted", 10, 1))
    emitted, following = track_entities(files, state, now, window)
    assert rows(emitted, "full_path") == [("edge",)]
    assert rows(following, "key") == [("edge",), ("gone",), ("same",)]
    first, kept = track_entities(files, empty(spark, ENTITY_STATE), now, window, "all", first_run=True)
    assert first.count() == 4 and rows(kept, "key") == [("edge",), ("same",)]
    first, _ = track_entities(files, empty(spark, ENTITY_STATE), now, window, "window", first_run=True)
    assert rows(first, "full_path") == [("edge",), ("same",)]


def test_initial_floor():
    assert initial_floor("all_files", True) is None
    assert initial_floor("new_files", True, now_ms=7) == 7
    assert initial_floor("from_timestamp", True, timestamp_ms=8) == 8
    assert initial_floor("from_timestamp", False, timestamp_ms=8) is None
    assert initial_floor("new_files", True, tracking="entities", now_ms=7) is None
    with pytest.raises(ValueError):
        initial_floor("other", True)


def test_fingerprint_and_reset(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("a", None), ("a", "-")], "s string, d string")
    prints = [r[0] for r in df.select(fingerprint({"service": F.col("s"), "directory": F.col("d")})).collect()]
    assert len(set(prints)) == 4
    state = spark.createDataFrame([("x", 1), ("y", 2)], "fingerprint string, v int")
    assert rows(surviving_state(state, spark.createDataFrame([("y",), ("y",)], "fingerprint string"))) == [("y", 2)]


def test_latest_per_path_matches_window(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17)).alias("path"),
                                  (F.col("id") * 7919 % 1000).alias("t"), F.col("id").alias("seq"))
    w = Window.partitionBy("path").orderBy(F.desc("t"), F.desc("seq"))
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(latest_per_path(df, ["t", "seq"], ["path"])) == rows(want)


def test_state_store(spark, tmp_path):
    store = StateStore(spark, f"{tmp_path}/s", TIMESTAMP_STATE)
    assert store.latest() is None and store.read().count() == 0
    store.write(next_state(inv(spark, ("a", "x", 1, 1))), 1)
    store.write(next_state(inv(spark, ("a", "y", 2, 1))), 2)
    assert store.versions() == [1, 2]
    assert rows(store.read(), "key") == [("y",)] and rows(store.read(before=2), "key") == [("x",)]
    (tmp_path / "s" / f"v={3:020d}").mkdir()  # a write that did not commit
    assert store.latest() == 2
    store.write(next_state(inv(spark, ("a", "z", 3, 1))), 3)
    store.prune(keep=2)
    assert store.versions() == [2, 3]


def test_a_run_is_not_repeated_without_its_state(spark, tmp_path):
    """Once the state before a run is dropped, repeating the run must not look like a first run."""
    files = inv(spark, ("a", "x", 1, 1), ("a", "y", 2, 1))
    for listing, run in ((TimestampListing(spark, f"{tmp_path}/t"), lambda v: listing.run(files, v, f"{tmp_path}/out")),
                         (EntityListing(spark, f"{tmp_path}/e", 10**9), lambda v: listing.run(files, v, f"{tmp_path}/out", 10**7))):
        assert [run(v).count() for v in range(1, 9)] == [2, 0, 0, 0, 0, 0, 0, 0]
        kept = listing.store.versions()
        assert kept == [4, 5, 6, 7, 8] and run(5).count() == 0
        for v in (3, 4):
            with pytest.raises(RuntimeError):
                run(v)
        assert listing.store.versions() == kept


def test_timestamp_listing_survives_retry(spark, tmp_path):
    listing = TimestampListing(spark, f"{tmp_path}/state")
    first = inv(spark, ("a", "x", 5, 1), ("a", "y", 3, 1))
    second = inv(spark, ("a", "x", 7, 1), ("a", "y", 3, 1), ("a", "z", 6, 1))  # x rewritten in place, z new
    assert rows(listing.run(first, 1, f"{tmp_path}/out", only="a"), "full_path") == [("x",), ("y",)]
    for _ in range(2):  # the second attempt of a run gives the same rows
        assert rows(listing.run(second, 2, f"{tmp_path}/out", only="a"), "full_path") == [("x",), ("z",)]
    assert listing.run(second, 3, f"{tmp_path}/out", only="a").count() == 0
    assert listing.run(second, 4, f"{tmp_path}/out").count() == 0


def test_entity_listing_sees_rewrites(spark, tmp_path):
    listing = EntityListing(spark, f"{tmp_path}/state", window_ms=10_000 * 60_000)
    first = inv(spark, ("a", "x", 5, 1), ("a", "y", 3, 1), ("a", "z", 3, 1))
    second = inv(spark, ("a", "x", 5, 2), ("a", "y", 3, 1), ("a", "z", 4, 1), ("a", "late", 1, 1))
    now = 100 * 60_000
    assert listing.run(first, 1, f"{tmp_path}/out", now).count() == 3
    for _ in range(2):
        assert rows(listing.run(second, 2, f"{tmp_path}/out", now), "full_path", "change") == [
            ("late", "new"), ("x", "changed"), ("z", "changed")]
    assert listing.run(second, 3, f"{tmp_path}/out", now).count() == 0
