"""Entity tracking with the stream's own state: rewrites, restarts, lifetimes."""

import time

from helpers import rows
from tidemark.streaming import track_entities_stream

SNAPSHOT = "container string, full_path string, last_modified timestamp, size bigint, listed_at timestamp"
MINUTE = 60_000


def snapshot(spark, folder, files, listed_ms):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(c, p, ms, s, listed_ms) for c, p, ms, s in files], "container string, full_path string, ms bigint, size bigint, at bigint")
    df.select("container", "full_path", F.timestamp_millis("ms").alias("last_modified"), "size", F.timestamp_millis("at").alias("listed_at")).write.mode("append").parquet(folder)


def run(spark, path, **more):
    """One run over what came since the last one, from the same checkpoint."""
    stream = track_entities_stream(spark.readStream.schema(SNAPSHOT).parquet(f"{path}/in"), **{"window_ms": 60 * MINUTE, "buckets": 3, **more})
    query = (stream.select("container", "full_path", "size", "change", "listed_at").writeStream.format("parquet").option("path", f"{path}/out")
             .option("checkpointLocation", f"{path}/checkpoint").trigger(once=True).start())
    assert query.awaitTermination(90)
    return query


def listed(spark, path):
    from pyspark.sql import functions as F

    return rows(spark.read.parquet(f"{path}/out").select((F.unix_millis("listed_at") / MINUTE).cast("int"), "container", "full_path", "size", "change"))


def test_rewrites_restarts_and_windows(spark, tmp_path):
    path, t = str(tmp_path), 1_000 * MINUTE
    files = [("a", "x", t, 1), ("a", "y", t - 30 * MINUTE, 1), ("b", "x", t, 1), ("a", "old", t - 70 * MINUTE, 1), ("a", "null", t, None)]
    snapshot(spark, f"{path}/in", files, t)
    run(spark, path, initial_ms=t)
    first = [(1_000, c, p, s, "new") for c, p, _, s in files]  # the first snapshot lists all
    assert listed(spark, path) == sorted(first, key=repr)
    # Restarted: nothing new, a rewritten file, one of another size, a late one inside the window, one outside of it.
    later = [("a", "x", t + MINUTE, 1), ("a", "y", t - 30 * MINUTE, 2), ("b", "x", t, 1), ("a", "old", t - 70 * MINUTE, 9),
             ("b", "late", t - 40 * MINUTE, 1), ("b", "too late", t - 59 * MINUTE, 1), ("a", "null", t, None)]
    snapshot(spark, f"{path}/in", later, t + 10 * MINUTE)
    run(spark, path, initial_ms=t)
    second = [(1_010, "a", "x", 1, "changed"), (1_010, "a", "y", 2, "changed"), (1_010, "b", "late", 1, "new")]
    assert listed(spark, path) == sorted(first + second, key=repr)
    # Two snapshots in one batch are compared in their order.
    snapshot(spark, f"{path}/in", [("b", "x", t + 20 * MINUTE, 5)], t + 21 * MINUTE)
    snapshot(spark, f"{path}/in", [("b", "x", t + 20 * MINUTE, 4)], t + 20 * MINUTE)
    run(spark, path, initial_ms=t)
    assert listed(spark, path)[-2:] == [(1_020, "b", "x", 4, "changed"), (1_021, "b", "x", 5, "changed")]


def test_entries_are_forgotten_after_the_window(spark, tmp_path):
    path, t = str(tmp_path), 1_000 * MINUTE
    for n in range(3):
        snapshot(spark, f"{path}/in", [("a", "x", t, 1)], t + n)
        run(spark, path, window_ms=15_000)
        if n == 1:
            time.sleep(16)
    # Known in the second run, forgotten in the third: the entry outlived the window on the wall clock.
    assert [r[1:] for r in listed(spark, path)] == [("a", "x", 1, "new")] * 2


def test_a_bucket_takes_few_calls_to_the_state_store(monkeypatch):
    """25,000 files of a bucket are three blocks, not as many entries (F2); a rewritten file is found, also twice in a batch."""
    import pandas as pd

    from tidemark.streaming.entity_stream import _Seen

    class Log(dict):
        calls = 0

        def exists(self):
            return bool(self)

        def iterator(self):
            return iter(self.items())

        def updateValue(self, number, block):
            Log.calls += 1
            self[number] = block

    columns = ["container", "full_path", "_bucket", "_listed", "_modified", "_size"]
    seen, t = _Seen(columns, "container", "full_path", 100, None), 1_000
    seen.log = Log()

    def run(*data):
        out = list(seen.handleInputRows(None, iter([pd.DataFrame(data, columns=columns)]), None))
        return [tuple(r) for r in pd.concat(out).itertuples(index=False)] if out else []

    files = [("a" if i % 2 else None, f"f{i}", 0, t, t, i) for i in range(25_000)]
    assert run(*files) == [(c, k, "new") for c, k, *_ in files] and Log.calls == 3
    assert run(*files) == [] and Log.calls == 3
    twice = [("a", "f1", 0, t + 1, t + 1, 1), ("a", "f1", 0, t + 2, t + 2, 1), ("a", "f1", 0, t + 3, t + 2, 1), (None, "f2", 0, t + 9, t + 9, None)]
    assert run(*twice, *files[3:]) == [("a", "f1", "changed"), ("a", "f1", "changed"), (None, "f2", "changed")] and Log.calls == 4
    assert run(*twice[2:], *files[3:]) == [] and run(("a", "f9", 0, t + 200, t + 99, 1)) == []


def test_a_large_bucket_is_compared_in_pieces(monkeypatch):
    """A bucket of 5,000 rows and as many entries: never more than a piece at a time, with the same changes (F2 of round 4)."""
    import random

    import pandas as pd

    from tidemark.streaming import entity_stream as module

    class Log(dict):
        def exists(self):
            return bool(self)

        def iterator(self):
            return iter(sorted(self.items(), reverse=True))  # blocks come in any order

        def updateValue(self, number, block):
            assert number not in self
            self[number] = block

    columns, pick, held = ["container", "full_path", "_bucket", "_listed", "_modified", "_size"], random.Random(4), []
    batches = [[(pick.choice(["a", "b", None]), f"f{pick.randrange(4_000)}", 0, 1_000 + n, 1_000 + pick.randrange(-150, 2), pick.choice([1, 2, None]))
                for _ in range(5_000)] for n in range(4)]

    def run(piece):
        monkeypatch.setattr(module, "PIECE", piece)
        monkeypatch.setattr(module, "BLOCK", 150)
        seen, out = module._Seen(columns, "container", "full_path", 100, 1_000), []
        compared = seen._compared
        monkeypatch.setattr(seen, "_compared", lambda rows, known: held.append(len(rows) + len(known)) or compared(rows, known), raising=False)
        seen.log = Log()
        for rows in batches:
            frames = [pd.DataFrame(rows[i:i + 100], columns=columns) for i in range(0, len(rows), 100)]
            listed = [tuple(r) for p in seen.handleInputRows(None, iter(frames), None) for r in p.itertuples(index=False)]
            out.append(sorted(listed, key=repr))
        return out

    whole, most = run(1_000_000), max(held)
    held.clear()
    assert run(1_000) == whole and len(whole[0]) > 3_000 and len(whole[3]) > 1_000
    assert max(held) <= 1_000 < 5_000 <= most


def test_the_state_store_is_bounded_unless_the_session_says_otherwise(spark):
    """Blocks come ten at a time, so a bucket's log is never in memory at once (F2 of round 4)."""
    from tidemark.streaming import entity_stream as module

    (blocks, ten), (buffer, _) = module.STATE_MEMORY
    try:
        spark.conf.set(buffer, "5")
        module.needs_rocksdb(spark)
        assert (spark.conf.get(blocks), spark.conf.get(buffer)) == (ten, "5")
    finally:
        for name in (blocks, buffer):
            spark.conf.unset(name)
