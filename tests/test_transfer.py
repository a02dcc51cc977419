import os
import random

import pytest
from helpers import rows
from pyspark.sql import Window, functions as F

from tidemark.operators import transfer
from tidemark.operators import effects
from tidemark.operators.effects import complete, delete_files, fetch_commit_complete, lost_batches, publish
from tidemark.operators.routes import route_delete
from tidemark.plans.ranking import running_number
from tidemark.plans.storage import stage
from tidemark.sources.content import attach_content, fetch_chunks, fetch_content
from tidemark.sources import inventory as inventory_source
from tidemark.sources.inventory import scan_inventory
from tidemark.sources.sinks import read_listing_ids, write_empty, write_listing
from tidemark.schema import INVENTORY


def requests(spark, *data):
    """(seq, host, directory, filename, conflict) rows."""
    df = spark.createDataFrame(list(data), "seq bigint, host string, directory string, filename string, conflict string")
    return transfer.with_destination(df.withColumn("share", F.lit("s")))


def existing(spark, *data):
    return spark.createDataFrame(list(data), "host string, dest string").withColumn("share", F.lit("s"))


@pytest.mark.parametrize("hot_rows", [10, 50, 500, 5000])
def test_running_number_in_slices(spark, hot_rows):
    """A hot group, repeated lead values and a second order column."""
    df = spark.range(5000).select(F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
                                  (F.col("id") * 7919 % 600).alias("a"), F.col("id").alias("b"))
    w = Window.partitionBy("g").orderBy("a", "b")
    want = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    got = running_number(df, ["g"], ["a", "b"], hot_rows=hot_rows)
    assert rows(got, "g", "a", "b", "rn") == rows(want, "g", "a", "b", "rn")


def test_slices_balance_a_hot_group(spark):
    df = spark.range(20_000).select(F.when(F.col("id") >= 0, "hot").alias("g"), "id")
    got = running_number(df, ["g"], ["id"], hot_rows=2_500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("_slice" in line for line in windows)
    assert got.agg(F.max("rn"), F.countDistinct("rn")).first() == (20_000, 20_000)


@pytest.mark.parametrize("kind", ["string", "date", "double"])
def test_numbers_do_not_depend_on_type_ties_or_size(spark, kind):
    """Text, dates and one value repeated through a hot group number alike below and above the threshold."""
    a = {"string": F.concat(F.lit("n"), F.col("id") % 3), "date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")),
         "double": F.lit(1.0)}[kind]
    df = spark.range(400).select(F.when(F.col("id") % 4 != 0, "hot").alias("g"), a.alias("a"), (F.col("id") * 37 % 400).alias("b"))
    w = Window.partitionBy("g").orderBy("a", "b")
    want = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    got = running_number(df, ["g"], ["a", "b"], hot_rows=5)
    assert got.dtypes == running_number(df, ["g"], ["a", "b"]).dtypes
    assert rows(got, "g", "a", "b", "rn") == rows(want, "g", "a", "b", "rn")
    tied = running_number(df, ["g"], ["a"], hot_rows=5)
    assert sorted(r.rn for r in tied.where("g = 'hot'").collect()) == list(range(1, 301))


def test_a_large_next_batch_is_cut_without_one_large_task(spark):
    df = requests(spark, *[(i, "h", "d", f"f{i}", "fail") for i in range(3_000)])
    got = transfer.next_batch(df, 2_000, hot_rows=500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("_slice" in line for line in plan.splitlines() if "row_number()" in line and "Window" in line)
    assert sorted(r.seq for r in got.collect()) == list(range(2_000))


def test_batches(spark):
    df = requests(spark, *[(i, "h" if i % 2 else "g", "d", f"f{i}", "fail") for i in range(1, 22)])
    got = transfer.assign_batches(df, 4)
    sizes = sorted((r["host"], r["batch_no"], r["count"]) for r in got.groupBy("host", "batch_no").count().collect())
    assert sizes == [("g", 1, 4), ("g", 2, 4), ("g", 3, 2), ("h", 1, 4), ("h", 2, 4), ("h", 3, 3)]
    assert rows(got.where("batch_no = 1"), "seq") == rows(transfer.next_batch(df, 4), "seq")


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**9), (2, 10**9), (3, 10), (4, 1)])
def test_write_plan_one_by_one(spark, seed, hot_rows):
    """Against handling the requests in order, one at a time."""
    rnd = random.Random(seed)
    policy = {f"f{i}": rnd.choice(["replace", "ignore", "fail"]) for i in range(20)}
    reqs = [(i, rnd.choice("gh"), rnd.choice(["d", "", "d/e", "gone"]), "hot" if rnd.random() < 0.4 else f"f{rnd.randint(0, 19)}")
            for i in range(200)]
    reqs = [(i, h, d, f, policy.get(f, "ignore")) for i, h, d, f in reqs]
    there = {("g", "d/f1"), ("g", "f2"), ("h", "d/e/f3"), ("h", "hot")}
    dirs = {("g", "d"), ("h", "d"), ("h", "d/e")}
    held, want = set(there), []
    for i, h, d, f, c in sorted(reqs):
        dest = f"{d}/{f}" if d else f
        if d and (h, d) not in dirs:
            want.append((i, "missing_directory"))
        elif (h, dest) not in held:
            held.add((h, dest))
            want.append((i, "create"))
        else:
            want.append((i, {"replace": "overwrite", "ignore": "skip", "fail": "reject"}[c]))
    existing_dirs = spark.createDataFrame(sorted(dirs), "host string, dest_dir string").withColumn("share", F.lit("s"))
    plan = transfer.plan_writes(requests(spark, *reqs), existing(spark, *sorted(there), *sorted(there)), existing_dirs, batch_size=7,
                                hot_rows=hot_rows)
    assert rows(plan, "seq", "write_action") == sorted(want, key=repr)
    order = {}
    for i, h, *_ in sorted(reqs):
        order.setdefault(h, []).append(i)
    assert dict(rows(plan, "seq", "batch_no")) == {i: n // 7 + 1 for seqs in order.values() for n, i in enumerate(seqs)}
    routes = dict(rows(transfer.route_write(plan), "seq", "route"))
    assert routes == {i: "failure" if a in ("reject", "missing_directory") else "success" for i, a in want}


def test_conflicts_without_prefilter_agree(spark, monkeypatch):
    reqs = requests(spark, *[(i, "h", "d", f"f{i % 7}", "fail") for i in range(50)])
    there = existing(spark, ("h", "d/f1"), ("h", "d/other"))
    sizes = iter([100, 1] * 2)  # many files, few requests
    monkeypatch.setattr(transfer, "estimated_bytes", lambda df: next(sizes))
    monkeypatch.setattr(transfer, "measure", lambda df: True)
    with_filter = rows(transfer.resolve_conflicts(reqs, there), "seq", "target_exists")
    monkeypatch.setattr(transfer, "measure", lambda df: False)
    assert rows(transfer.resolve_conflicts(reqs, there), "seq", "target_exists") == with_filter


def test_failed_connection_fails_the_batch(spark):
    df = requests(spark, *[(i, "h", "d", f"f{i}", "replace") for i in range(6)])
    plan = transfer.plan_writes(df, existing(spark, ("x", "y")), create_dirs=True, batch_size=3)
    lost = spark.createDataFrame([("h", "s", 2)], "host string, share string, batch_no bigint")
    routed = transfer.route_write(plan, spark.createDataFrame([(0,)], "seq bigint"), lost)
    assert rows(routed.where("route = 'failure'"), "seq") == [(0,), (3,), (4,), (5,)]


def test_directories(spark):
    df = requests(spark, (1, "h", "a/b/c", "f", "fail"), (2, "h", "a/b", "f", "fail"), (3, "h", "", "f", "fail"),
                  (4, "h", "/x/y", "f", "fail"))
    there = spark.createDataFrame([("h", "s", "a")], "host string, share string, dest_dir string")
    got = transfer.plan_directories(df, there)
    assert rows(got, "dest_dir", "depth") == [("/x", 1), ("/x/y", 2), ("a/b", 2), ("a/b/c", 3)]


def test_completion_plan(spark):
    df = spark.createDataFrame([("a/f", "f", "success"), ("a/g", "g", "failure")], "full_path string, filename string, route string")
    move = transfer.plan_completion(df, "move", F.lit("done"), create_directory=True)
    assert rows(move, "full_path", "completion", "move_to", "ensure_directory") == [
        ("a/f", "move", "done/f", "done"), ("a/g", "none", None, None)]
    assert rows(transfer.plan_completion(df, "none"), "completion") == [("none",), ("none",)]
    assert rows(transfer.plan_completion(df, "delete"), "completion", "move_to") == [("delete", None), ("none", None)]
    with pytest.raises(ValueError):
        transfer.plan_completion(df, "move")


def plan_of(spark, reqs, there=()):
    df = requests(spark, *[r[:5] for r in reqs])
    plan = transfer.plan_writes(df, existing(spark, *(there or [("none", "none")])), create_dirs=True, batch_size=None)
    return plan, spark.createDataFrame([(r[0], bytearray(r[5])) for r in reqs], "seq bigint, content binary")


@pytest.mark.parametrize("suffix", [None, ".part", " "])
def test_publish(spark, tmp_path, suffix):
    base = tmp_path / "h" / "s"
    (base / "d").mkdir(parents=True)
    (base / "d" / "old").write_bytes(b"old")
    reqs = [(1, "h", "d", "new", "fail", b"1"), (2, "h", "d/e", "deep", "replace", b"2"), (3, "h", "d", "old", "replace", b"3"),
            (4, "h", "d", "new", "fail", b"4"), (5, "h", "d/e", "deep", "replace", b"5"), (6, "h", "d", "empty", "fail", b"")]
    out = publish(*plan_of(spark, reqs, [("h", "d/old")]), str(tmp_path), suffix)
    got = {r["seq"]: (r["write_action"], r["done"]) for r in out.collect()}
    assert got == {1: ("create", True), 2: ("create", True), 3: ("overwrite", True), 4: ("reject", None), 5: ("overwrite", True),
                   6: ("create", True)}
    assert (base / "d" / "new").read_bytes() == b"1"
    assert (base / "d/e/deep").read_bytes() == b"5"  # the last write counts
    assert (base / "d" / "old").read_bytes() == b"3"
    assert (base / "d" / "empty").read_bytes() == b""
    assert not [f for _, _, fs in os.walk(tmp_path) for f in fs if "part" in f]


def test_a_lost_target_fails_the_rest_of_its_batch(spark, tmp_path):
    """A host that refuses in the middle of a batch: that batch fails as a whole, other batches and hosts go on."""
    for host in "ab":
        (tmp_path / host / "s").mkdir(parents=True)
        (tmp_path / host / "s" / "blocked").write_bytes(b"a file where a folder is needed")
    names = ["d", "d", "blocked", "d", "d", "d"]  # batches of four: the third request fails
    reqs = [(i * 10 + n, host, d, f"f{n}", "replace", b"x") for i, host in enumerate("ab") for n, d in enumerate(names)]
    plan = transfer.plan_writes(requests(spark, *[r[:5] for r in reqs]), existing(spark, ("none", "none")), create_dirs=True, batch_size=4)
    content = spark.createDataFrame([(r[0], bytearray(r[5])) for r in reqs], "seq bigint, content binary")

    def connect(root):
        if root.endswith("/a/s"):
            raise ConnectionError("gone")

    out = publish(plan, content, str(tmp_path), connect=connect)
    got = {r["seq"]: (r["done"], r["batch_lost"]) for r in out.collect()}
    assert got == {0: (True, True), 1: (True, True), 2: (False, True), 3: (False, True), 4: (True, False), 5: (True, False),
                   10: (True, False), 11: (True, False), 12: (False, False), 13: (True, False), 14: (True, False), 15: (True, False)}
    assert not (tmp_path / "a/s/d/f3").exists() and (tmp_path / "b/s/d/f3").exists()
    routed = transfer.route_write(out, out.where("NOT done").select("seq"), lost_batches(out))
    assert [r[0] for r in rows(routed.where("route = 'failure'"), "seq")] == [0, 1, 12, 2, 3]
    assert rows(lost_batches(out)) == [("a", "s", 1)]


def test_publish_reports_errors_per_file(spark, tmp_path):
    (tmp_path / "h" / "s").mkdir(parents=True)
    (tmp_path / "h" / "s" / "blocked").write_bytes(b"a file where a folder is needed")
    out = publish(*plan_of(spark, [(1, "h", "blocked", "f", "fail", b"1"), (2, "h", "fine", "f", "fail", b"2")]), str(tmp_path))
    got = {r["seq"]: (r["done"], bool(r["message"])) for r in out.collect()}
    assert got == {1: (False, True), 2: (True, False)}


def test_publish_keeps_hosts_apart_and_answers_every_request(spark, tmp_path):
    reqs = [(1, "h1", "d", "a", "replace", b"one"), (2, "h2", "d", "a", "replace", b"two"), (3, "h1", "d", "a", "replace", b"three"),
            (4, "h1", "d", "a", "replace", None), (5, "h3/x", "d", "b", "replace", None)]
    plan, content = plan_of(spark, [(*r[:5], r[5] or b"") for r in reqs])
    out = publish(plan, content.where("seq < 4"), str(tmp_path))
    got = {r["seq"]: (r["done"], r["code"], bool(r["message"])) for r in out.collect()}
    assert got == {1: (True, None, False), 2: (True, None, False), 3: (True, None, False),
                   4: (False, 3221225524, True), 5: (False, 3221225524, True)}
    assert (tmp_path / "h1/s/d/a").read_bytes() == b"three" and (tmp_path / "h2/s/d/a").read_bytes() == b"two"
    own = publish(plan.where("seq = 1"), content, F.concat(F.lit(f"{tmp_path}/own-"), F.col("host")))
    assert rows(own, "done") == [(True,)] and (tmp_path / "own-h1/d/a").read_bytes() == b"one"


def test_publish_falls_back_to_an_older_write(spark, tmp_path, monkeypatch):
    """The newest write fails; the one before it is carried out and is a success."""
    reqs = [(1, "h", "d", "a", "replace", b"one"), (2, "h", "d", "a", "replace", b"two"), (3, "h", "d", "a", "replace", b"three")]
    plan, content = plan_of(spark, reqs)
    (tmp_path / "bad").write_bytes(b"no folder")
    root = F.when(F.col("seq") == 3, F.lit(f"{tmp_path}/bad")).otherwise(F.lit(f"{tmp_path}/good"))
    got = {r["seq"]: (r["done"], bool(r["message"])) for r in publish(plan, content, root).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, True)}
    assert (tmp_path / "good/d/a").read_bytes() == b"two"


def test_fetch_keeps_columns_and_large_files_fail_alone(spark, tmp_path):
    (tmp_path / "big").write_bytes(b"x" * 1000)
    (tmp_path / "small").write_bytes(b"y")
    listing = spark.createDataFrame([("big", 1), ("small", 1), ("small", 2), ("small", 2), ("none", 3)], "full_path string, trigger_id int")
    got = fetch_content(listing, str(tmp_path), max_bytes=999)
    assert rows(got, "full_path", "trigger_id", "route", "error_code") == sorted(
        [("big", 1, "failure", "-2"), ("small", 1, "success", None), ("small", 2, "success", None), ("small", 2, "success", None),
         ("none", 3, "failure", "3221225524")], key=repr)
    chunks = fetch_chunks(listing, str(tmp_path), chunk_bytes=300)
    assert [(r["chunk_no"], len(r["content"])) for r in chunks.where("full_path = 'big'").orderBy("chunk_no").collect()] == [
        (0, 300), (1, 300), (2, 300), (3, 100)]
    assert rows(chunks.where("content IS NULL"), "full_path") == [("none",)]


def test_nothing_is_moved_before_the_commit(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"1")
    listing = spark.createDataFrame([(1, "a", "a"), (2, "gone", "gone")], "seq bigint, full_path string, filename string")

    def broken(fetched):
        raise OSError("the store is full")

    with pytest.raises(OSError):
        fetch_commit_complete(listing, str(tmp_path), broken, "move", F.lit("done"), True)
    assert (tmp_path / "a").exists()
    stored, outcome = fetch_commit_complete(listing, str(tmp_path), lambda f: stage(f, "t"), "move", F.lit("done"), True, f"{tmp_path}/marks")
    assert rows(stored, "seq", "route") == [(1, "success"), (2, "failure")] and rows(outcome, "seq", "done") == [(1, True)]
    assert (tmp_path / "done/a").read_bytes() == b"1" and not (tmp_path / "a").exists()
    plan = transfer.plan_completion(stored, "move", F.lit("done"), create_directory=True)
    assert rows(complete(plan, str(tmp_path), f"{tmp_path}/marks"), "done") == [(True,)]  # as a repeated task sees it
    assert rows(complete(plan, str(tmp_path)), "done") == [(False,)]


def test_delete_without_a_path(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "seq bigint, path string")
    assert rows(delete_files(df, str(tmp_path)), "done", "message") == [(False, "no path")]


def test_delete(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(b"x")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "missing"), (4, "a")], "seq bigint, path string")
    out = route_delete(delete_files(df, str(tmp_path)), F.col("done"))
    assert out.count() == 4  # looking at the outcomes repeats nothing
    assert rows(out, "seq", "route", "error_code") == [
        (1, "success", None), (2, "success", None), (3, "not found", None), (4, "not found", None)]
    assert not (tmp_path / "a").exists() and not (tmp_path / "b").exists()


def test_delete_outcomes_and_retry(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    df = spark.createDataFrame([(1, "a"), (3, "missing"), (4, "a")], "seq bigint, path string")
    for _ in range(2):  # the second round stands for a task that runs again
        out = route_delete(delete_files(df, str(tmp_path), f"{tmp_path}/marks"), F.col("done"))
        assert rows(out, "seq", "route", "error_code") == [(1, "success", None), (3, "not found", None), (4, "not found", None)]
    assert rows(route_delete(delete_files(df, str(tmp_path)), F.col("done")), "route") == [("not found",)] * 3


def test_many_deletes_are_spread_and_leave_few_marks(spark, tmp_path, monkeypatch):
    """As many tasks as asked for, though the paths were grouped in as many before; a repeated call finds its deletes listed (F14)."""
    (tmp_path / "files").mkdir()
    for i in range(3_000):
        (tmp_path / "files" / f"f{i}").touch()
    df = spark.range(6_000).select(F.col("id").alias("seq"), F.concat(F.lit("f"), (F.col("id") % 3_500).cast("string")).alias("path"))
    n, tasks = int(spark.conf.get("spark.sql.shuffle.partitions")), []

    def counted(work, label):
        if label == "deleted":
            tasks.append(work.rdd.getNumPartitions())
        return stage(work, label)

    monkeypatch.setattr(effects, "stage", counted)
    for _ in range(2):
        out = delete_files(df, f"{tmp_path}/files", f"{tmp_path}/marks", partitions=n)
        assert rows(out.where("done"), "seq") == sorted([(i,) for i in range(3_000)], key=repr)
        assert out.where("NOT done").count() == 3_000
    assert tasks == [n, n]
    assert not list((tmp_path / "files").iterdir())
    assert sum(p.is_file() for p in (tmp_path / "marks").rglob("*")) < 1_500


def test_marks_that_were_cut_off_say_nothing(tmp_path):
    """Another task's list counts, a list that was not finished and a task's own do not."""
    mine, other = effects._Marks(str(tmp_path)), effects._Marks(str(tmp_path))
    mine.begin(1, ["a"])
    other.begin(1, ["b", "c"])
    (tmp_path / "1" / "broken").write_text('["d')
    assert mine.begun(1) == {"b", "c"} and other.begun(1) == {"a"} and mine.begun(2) == set()


def test_completion_twice_and_without_a_path(spark, tmp_path):
    """A file that is asked for twice is moved once and both are done; a row without a path fails alone."""
    (tmp_path / "a").write_bytes(b"a")
    plan = spark.createDataFrame([(1, "a", "move", "b", None), (2, "a", "move", "b", None), (3, None, "delete", None, None)],
                                 "seq bigint, full_path string, completion string, move_to string, ensure_directory string")
    assert rows(complete(plan, str(tmp_path)), "seq", "done") == [(1, True), (2, True), (3, False)]
    assert (tmp_path / "b").read_bytes() == b"a" and not (tmp_path / "a").exists()


def test_complete(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(name.encode())
    df = spark.createDataFrame([(1, "a", "a", "success"), (2, "b", "b", "failure"), (3, "c", "c", "success")],
                               "seq bigint, full_path string, filename string, route string")
    move = transfer.plan_completion(df, "move", F.lit("done"), create_directory=True)
    assert rows(complete(move, str(tmp_path)), "seq", "done") == [(1, True), (3, False)]
    assert (tmp_path / "done" / "a").read_bytes() == b"a" and (tmp_path / "b").exists()
    gone = transfer.plan_completion(df.where("seq = 2").withColumn("route", F.lit("success")), "delete")
    assert rows(complete(gone, str(tmp_path)), "done") == [(True,)] and not (tmp_path / "b").exists()


def test_fetch(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f").write_bytes(b"\x00\xff")
    listing = spark.createDataFrame([("d/f",), ("d/none",), ("d",), (None,)], "full_path string")
    got = {r["full_path"]: r for r in fetch_content(listing, str(tmp_path), partitions=2).collect()}
    assert (got["d/f"]["route"], bytes(got["d/f"]["content"])) == ("success", b"\x00\xff")
    for bad in ("d/none", "d", None):
        assert got[bad]["route"] == "failure" and got[bad]["content"] is None and got[bad]["error_code"] and got[bad]["error_message"]


def test_attach_content_normalises(spark):
    listing = spark.createDataFrame([("/d/f",), ("d/g",)], "full_path string")
    content = spark.createDataFrame([("d\\f", bytearray(b"1"))], "path string, content binary")
    assert rows(attach_content(listing, content), "full_path", "route", "error_code") == [
        ("/d/f", "success", None), ("d/g", "failure", "3221225524")]


def test_scan(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f.csv").write_bytes(b"123")
    (tmp_path / "g.csv").write_bytes(b"1")
    (tmp_path / "h.txt").write_bytes(b"")
    got = scan_inventory(spark, str(tmp_path), glob="*.csv")
    assert got.columns == INVENTORY.fieldNames()
    assert rows(got, "directory", "filename", "full_path", "size") == [("", "g.csv", "g.csv", 1), ("d", "f.csv", "d/f.csv", 3)]
    assert rows(scan_inventory(spark, str(tmp_path), recursive=False), "filename") == [("g.csv",), ("h.txt",)]
    (tmp_path / "d" / "_e").mkdir()
    (tmp_path / "d" / "_e" / ".hidden").write_bytes(b"x")
    assert ("d/_e", ".hidden", 1) in rows(scan_inventory(spark, str(tmp_path)), "directory", "filename", "size")
    tree = scan_inventory(spark, str(tmp_path), with_directories=True).where("is_directory")
    assert rows(tree, "full_path") == [("d",), ("d/_e",)]


def test_scan_joins_names_as_they_are_and_reports_folders(spark, tmp_path, monkeypatch):
    """A folder named with a blank, its namesake at the top, and a folder that is gone when its turn comes."""
    (tmp_path / " " / "sub").mkdir(parents=True)
    (tmp_path / " " / "sub" / "f").write_bytes(b"1")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "g").write_bytes(b"2")
    got = scan_inventory(spark, str(tmp_path))
    assert rows(got, "full_path") == [(" /sub/f",), ("sub/g",)]
    real, root = inventory_source.stage, tmp_path

    def stage_and_remove(df, label):
        out = real(df, label)
        if (root / "sub").exists():
            (root / "sub" / "g").unlink()
            (root / "sub").rmdir()
        return out

    monkeypatch.setattr(inventory_source, "stage", stage_and_remove)
    found = {r.full_path: (r.is_directory, "error.message" in r.extra) for r in scan_inventory(spark, str(root)).collect()}
    assert found == {" /sub/f": (False, False), "sub": (True, True)}


def test_csv_listings_hold_maps_as_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", {"k": "v"})], "trigger_id bigint, full_path string, extra map<string,string>")
    back = write_listing(df, f"{tmp_path}/l", "csv")
    assert rows(back, "trigger_id", "full_path", "extra") == [(1, "a", '{"k":"v"}')]
    assert write_empty(spark, INVENTORY, f"{tmp_path}/e", "csv") == {"record.count": "0", "mime.type": "text/csv"}


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_listing_sinks(spark, tmp_path, fmt):
    df = spark.range(10).select((F.col("id") % 2).alias("trigger_id"), F.col("id").alias("n"))
    back = write_listing(df, f"{tmp_path}/l", fmt)
    assert rows(back, "trigger_id", "n") == rows(df, "trigger_id", "n")
    assert rows(read_listing_ids(spark, f"{tmp_path}/l", fmt)) == [(0,), (1,)]
    assert write_empty(spark, INVENTORY, f"{tmp_path}/e", fmt)["record.count"] == "0"


def test_empty_parquet_keeps_its_schema(spark, tmp_path):
    write_empty(spark, INVENTORY, f"{tmp_path}/e")
    back = spark.read.parquet(f"{tmp_path}/e")
    assert back.columns == INVENTORY.fieldNames() and back.count() == 0


def large_keys(spark, folder):
    """Line items with parts above 100,000 and suppliers above 1,000, and their keys in order."""
    keys = [(1, 1, 5, 9_020), (1, 1, 6, 20), (1, 1, 150_000, 40), (1, 2, 3, 60)] + [(2, n, 7, 80) for n in range(96)] + [(3, 1, 5, 9_020), (3, 1, 6, 20)]
    data = [(*k, 1.0, "R", "F", "1998-06-01") for k in reversed(keys)]
    lines = spark.createDataFrame(data, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                                  "l_returnflag string, l_linestatus string, day string")
    lines.withColumn("l_shipdate", F.col("day").cast("date")).drop("day").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return keys


def test_batches_of_large_keys_follow_them(spark, tmp_path):
    from tidemark.catalog import QUERIES

    keys = large_keys(spark, tmp_path)
    numbered = {r[:4]: r[5] for r in rows(QUERIES["assign_batches"](spark, str(tmp_path)))}
    assert numbered == {k: 1 if i < 100 else 2 for i, k in enumerate(keys)}


def test_the_first_request_for_a_target_is_that_of_the_smallest_keys(spark):
    df = spark.createDataFrame([("h", "s", "d/f", 10_000, 1), ("h", "s", "d/f", 6_100, 2)], "host string, share string, dest string, seq bigint, part int")
    got = transfer.resolve_conflicts(df.withColumn("place", F.struct("part")), df.select("host", "share", "dest").where("false"), seq="place")
    assert rows(got, "part", "target_exists") == [(1, False), (2, True)]


def test_the_next_batch_of_large_keys_follows_them(spark, tmp_path):
    from tidemark.catalog import QUERIES

    keys = large_keys(spark, tmp_path)
    assert rows(QUERIES["next_batch"](spark, str(tmp_path))) == sorted(((*k, "c0") for k in keys[:100]), key=repr)


def test_fetches_are_spread_after_a_step_by_path(spark, tmp_path):
    """Paths that were grouped in as many parts as the files are read in: they are still dealt to that many tasks (F14)."""
    for i in range(20):
        (tmp_path / f"f{i}").write_bytes(b"x")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listing = spark.range(40).select(F.concat(F.lit("f"), (F.col("id") % 20).cast("string")).alias("full_path")).distinct()
    for got in (fetch_content(listing, str(tmp_path), partitions=n), fetch_chunks(listing, str(tmp_path), partitions=n)):
        assert got.rdd.getNumPartitions() == n
        assert rows(got, "full_path", "content") == sorted(((f"f{i}", b"x") for i in range(20)), key=repr)
