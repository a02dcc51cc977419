import random
import re

import pytest
from helpers import rows
from tidemark.plans.storage import stage
from tidemark.sources.sinks import write_manifest
from pyspark.sql import functions as F

from tidemark.functions import render, target_attributes
from tidemark.operators import listing as listing_module
from tidemark.operators.listing import (
    CONSTANT_PATTERNS, ListingTemplates, emit_attributes, error_rows, has_objects, list_for_triggers, match_triggers,
    resolve_triggers,
    route_listing, route_listing_s3, unmatched_triggers,
)
from tidemark.operators.summary import record_count
from tidemark.plans.joins import BroadcastLimit, hot_keys, join_checked, measure, salted_join

NOTHING_FITS = BroadcastLimit(0, 0)
T = ListingTemplates(container="${bucket}", prefix="${prefix}", file_filter="${ff}")


def triggers(spark, *data):
    return spark.createDataFrame([(i, a) for i, a in data], "trigger_id bigint, attrs map<string,string>")


def files(spark, data):
    df = spark.createDataFrame(data, "container string, full_path string, size bigint")
    return df.withColumn("directory", F.regexp_replace("full_path", "/?[^/]*$", "")) \
             .withColumn("filename", F.substring_index("full_path", "/", -1)).withColumn("is_directory", F.lit(False))


def random_case(spark, seed, n_triggers=30, n_files=400):
    """Triggers and files with a hot container, and the pairs by brute force."""
    rnd = random.Random(seed)
    parts = ["a", "ab", "b", "c"]
    inv = [("hot" if rnd.random() < 0.5 else rnd.choice("xyz"),
            "/".join(rnd.choices(parts, k=rnd.randint(0, 3)) + [f"f{i}.{rnd.choice(['csv', 'txt'])}"]), i) for i in range(n_files)]
    prefixes = ["", "a", "a/", "a/b", "ab/c", "/", "a/b/f1", "zz", "c/"]
    patterns = ["", " ", r".*\.csv", "f1.*", "nomatch", "f1|f1.*"]
    trig = [(i, {"bucket": rnd.choice(["hot", "x", "y", "none"]), "prefix": rnd.choice(prefixes), "ff": rnd.choice(patterns)})
            for i in range(n_triggers)]
    want = sorted((t, p) for t, a in trig for c, p, _ in inv if c == a["bucket"] and p.startswith(a["prefix"])
                  and (not a["ff"].strip() or re.fullmatch(a["ff"], p.rsplit("/", 1)[-1])))
    return triggers(spark, *trig), files(spark, inv), want


@pytest.mark.parametrize("limit", [BroadcastLimit(), NOTHING_FITS], ids=["broadcast", "salted"])
@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_listing_by_brute_force(spark, limit, seed):
    t, inv, want = random_case(spark, seed)
    got = list_for_triggers(t, inv, T, limit=limit)
    assert rows(got, "trigger_id", "full_path") == sorted(want, key=repr)
    empty = sorted({r[0] for r in t.select("trigger_id").collect()} - {w[0] for w in want})
    assert [r[0] for r in sorted(rows(unmatched_triggers(t, got), "trigger_id"))] == empty
    counts = dict(rows(record_count(t, got)))
    assert counts == {i: sum(w[0] == i for w in want) for i in range(30)}


@pytest.mark.parametrize("limit", [BroadcastLimit(), NOTHING_FITS], ids=["broadcast", "salted"])
@pytest.mark.parametrize("recursive", [True, False])
def test_directory_listing_by_brute_force(spark, limit, recursive):
    t, inv, _ = random_case(spark, 3)
    by_dir = ListingTemplates(container="${bucket}", directory="${prefix}", recursive=recursive)
    want = []
    for tid, a in [(r["trigger_id"], r["attrs"]) for r in t.collect()]:
        d = a["prefix"].strip("/")
        for c, p in [(r["container"], r["directory"]) for r in inv.collect()]:
            inside = p == d or (recursive and (d == "" or p.startswith(d + "/")))
            if c == a["bucket"] and inside:
                want.append((tid, p))
    got = list_for_triggers(t, inv, by_dir, limit=limit)
    assert rows(got, "trigger_id", "directory") == sorted(want, key=repr)


def test_more_patterns_than_fit_the_plan(spark):
    n = CONSTANT_PATTERNS + 10
    t = triggers(spark, *[(i, {"bucket": "b", "prefix": "", "ff": f"f{i}[.]csv"}) for i in range(n)])
    inv = files(spark, [("b", f"d/f{i}.csv", 1) for i in range(n)])
    for limit in (BroadcastLimit(), NOTHING_FITS):
        assert list_for_triggers(t, inv, T, limit=limit).count() == n


def test_bad_pattern_fails_its_own_trigger_only(spark):
    t = triggers(spark, (1, {"bucket": "b", "ff": "["}), (2, {"bucket": "b", "ff": "f.*"}), (3, {"bucket": "b", "ff": "a)(b"}))
    inv = files(spark, [("b", "f.txt", 1)])
    assert rows(resolve_triggers(t, T), "trigger_id", "is_valid") == [(1, False), (2, True), (3, False)]
    assert rows(list_for_triggers(t, inv, T), "trigger_id") == [(2,)]


def test_has_objects(spark):
    t = triggers(spark, (1, {"bucket": "b", "prefix": ""}), (2, {"bucket": "b"}), (3, {"bucket": "b", "prefix": " "}),
                 (4, {"bucket": "b", "prefix": "d/f"}), (5, {"bucket": "none", "prefix": ""}), (6, {"bucket": "b", "prefix": "d/x"}))
    got = has_objects(files(spark, [("b", "d/f.txt", 1)]), t, T)
    assert rows(got, "trigger_id", "has_objects") == [(1, True), (2, True), (3, False), (4, True), (5, False), (6, False)]


def test_routes_cover_each_trigger_once(spark):
    t, inv, want = random_case(spark, 5)
    failed = t.where("trigger_id % 7 = 0").select("trigger_id", F.lit("lost").alias("error_message"))
    got = route_listing(t, list_for_triggers(t, inv, T), failed=failed)
    routes = {}
    for tid, route in rows(got.select("trigger_id", "route").distinct()):
        assert tid not in routes
        routes[tid] = route
    assert set(routes) == set(range(30))
    matched = {w[0] for w in want}
    for tid, route in routes.items():
        assert route == ("failure" if tid % 7 == 0 else "success" if tid in matched else "no_files")


def test_old_matches_give_no_row(spark):
    t = triggers(spark, (1, {"bucket": "b"}), (2, {"bucket": "c"}))
    m = list_for_triggers(t, files(spark, [("b", "f.txt", 1)]), T)
    got = route_listing(t, m, emitted=m.where("size > 1"))
    assert rows(got, "trigger_id", "route") == [(2, "no_files")]
    assert route_listing(t, m, emitted=m.where("size > 1"), records_requested=False).count() == 0


def test_directories_do_not_count_as_files(spark):
    t = triggers(spark, (1, {"bucket": "b"}))
    m = list_for_triggers(t, files(spark, [("b", "sub", 0)]).withColumn("is_directory", F.lit(True)), T)
    assert rows(route_listing(t, m), "route") == [("no_files",), ("success",)]


def test_s3_tests_emptiness_before_filters(spark):
    t = triggers(spark, (1, {"bucket": "b", "ff": "nomatch"}), (2, {"bucket": "none"}), (3, {"bucket": "b"}))
    inv = files(spark, [("b", "f.txt", 1)])
    got = route_listing_s3(t, inv, list_for_triggers(t, inv, T), T)
    assert rows(got, "trigger_id", "route") == [(2, "no_files"), (3, "success")]


def test_listing_attributes_take_precedence(spark):
    t = triggers(spark, (1, {"bucket": "b", "batch.id": "12345", "origin": "trigger"}))
    m = list_for_triggers(t, files(spark, [("b", "object-key.txt", 1)]), T, with_attrs=True)
    listing = F.create_map(F.lit("filename"), F.col("filename"), F.lit("origin"), F.lit("listing"))
    assert emit_attributes(m, listing).first()["attributes"] == {
        "bucket": "b", "batch.id": "12345", "origin": "listing", "filename": "object-key.txt"}


def test_error_rows(spark):
    t = triggers(spark, (1, {"target.host": "h", "origin": "trigger"}))
    causes = F.array(F.struct(F.lit("IOError").alias("class"), F.lit("Could not perform listing").alias("message")),
                     F.struct(F.lit("Refused").alias("class"), F.lit("access denied").alias("message")))
    target = target_attributes("sftp", render("${target.host}", F.col("attrs")), F.lit(22), F.lit("u"))
    deep = error_rows(t, causes, target, deepest=True).first()
    assert deep["route"] == "failure"
    assert deep["attributes"] == {"target.host": "h", "origin": "trigger", "sftp.remote.host": "h", "sftp.remote.port": "22",
                                  "sftp.listing.user": "u", "error.message": "access denied", "error.class": "Refused"}
    outer = error_rows(t, causes, target).first()["attributes"]
    assert (outer["error.class"], outer["error.message"]) == ("IOError", "Could not perform listing")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_agrees_with_plain_join(spark, how):
    large = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(5, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = rows(large.join(small, "k", how))
    for hot_rows in (1, 100, 10**9):
        assert rows(salted_join(large, small, ["k"], how, hot_rows=hot_rows)) == want
    assert rows(join_checked(large, small, ["k"], how, limit=NOTHING_FITS)) == rows(join_checked(large, small, ["k"], how))


def test_hot_keys(spark):
    large = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"))
    assert rows(hot_keys(large, ["k"], 300)) == [(7, 4)]
    assert hot_keys(large, ["k"], 1000) is None and hot_keys(large, ["k"], 3000) is None


def test_rows_without_a_key_are_kept_and_spread(spark):
    large = spark.range(500).select("id", F.when(F.col("id") % 2 == 0, 1).alias("k"))
    small = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(salted_join(large, small, ["k"], how, hot_rows=50)) == rows(large.join(small, "k", how))


def test_salted_join_spreads_a_hot_key(spark):
    large = spark.range(4000).select("id", F.when(F.col("id") >= 0, 1).alias("k"))
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = salted_join(large, small, ["k"], hot_rows=100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 1500  # hashing need not hit every partition


def test_measure_counts_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"), F.create_map(F.lit("k"), F.lit("v")).alias("m"))
    assert measure(df)
    assert not measure(df, BroadcastLimit(rows=99))
    assert not measure(df, BroadcastLimit(bytes=90_000))




def test_prefixes_in_one_folder_meet_only_their_files(spark):
    """1,000 prefixes below one folder: the join gives as many pairs as there are matches."""
    triggers = spark.range(1_000).select(F.col("id").alias("trigger_id"), F.create_map(
        F.lit("p"), F.format_string("data/2024-%04d-", "id")).cast("map<string,string>").alias("attrs"))
    names = F.format_string("2024-%04d-%d", F.col("id") % 1_500, F.col("id"))
    files = spark.range(3_000).select(F.lit("c").alias("container"), F.lit("data").alias("directory"), names.alias("filename"),
                                      F.concat(F.lit("data/"), names).alias("full_path"), F.lit(1).cast("bigint").alias("size"),
                                      F.lit(False).alias("is_directory"), F.lit(None).cast("timestamp").alias("last_modified"))
    got = list_for_triggers(triggers, files, ListingTemplates(container="c", prefix="${p}"), None)
    assert got.count() == 2_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "t_anchor" in plan
    side, t = listing_module._anchored(files, [15], True), triggers.select("trigger_id", F.col("attrs")["p"].alias("t_anchor"))
    assert side.join(t, "t_anchor").count() == 2_000  # no pair is left for the prefix test to drop


def nested_case(spark, seed, n_triggers, n_files, lengths):
    """Keys over two letters, so that prefixes of many lengths enclose each other."""
    rnd = random.Random(seed)
    inv = [(rnd.choice(["a", "b"]), "".join(rnd.choices("xy", weights=[5, 1], k=rnd.randint(0, lengths + 5))), i) for i in range(n_files)]
    heads = [rnd.choice(inv)[:2] for _ in range(n_triggers)]
    trig = [(i, {"bucket": c, "prefix": key[:rnd.randint(0, lengths)] + rnd.choice(["", "", "z"]), "ff": ""}) for i, (c, key) in enumerate(heads)]
    want = sorted(((t, k, n) for t, a in trig for c, k, n in inv if c == a["bucket"] and k.startswith(a["prefix"])), key=repr)
    return triggers(spark, *trig), files(spark, inv), want


@pytest.mark.parametrize("seed", [3, 4])
def test_nested_prefixes_by_brute_force(spark, seed):
    t, inv, want = nested_case(spark, seed, 120, 300, 20)
    got = list_for_triggers(t, inv, T)
    assert rows(got, "trigger_id", "full_path", "size") == want and len(want) > 1_000


@pytest.mark.parametrize("recursive", [True, False])
def test_nested_folders_by_brute_force(spark, recursive):
    rnd = random.Random(5)
    paths = ["/".join(rnd.choices(["a", "ab", "é"], weights=[6, 1, 1], k=rnd.randint(0, 9)) + [f"f{i}"]) for i in range(300)]
    wanted = ["/".join(rnd.choices(["a", "ab", "é"], weights=[6, 1, 1], k=rnd.randint(0, 8))) for _ in range(60)]
    t = triggers(spark, *[(i, {"bucket": "b", "prefix": rnd.choice(["", "/"]) + w}) for i, w in enumerate(wanted)])
    got = list_for_triggers(t, files(spark, [("b", p, i) for i, p in enumerate(paths)]),
                            ListingTemplates(container="${bucket}", directory="${prefix}", recursive=recursive))

    def inside(path, folder):
        parts, where = path.split("/")[:-1], folder.split("/") if folder else []
        return parts[:len(where)] == where if recursive else parts == where

    assert rows(got, "trigger_id", "full_path") == sorted(((i, p) for i, w in enumerate(wanted) for p in paths if inside(p, w)), key=repr)


def test_thousand_prefixes_of_300_lengths_make_no_pair_to_drop(spark):
    """After the lookup there is one row per file, after the join exactly the matches, and no file was copied or shuffled."""
    t, inv, want = nested_case(spark, 6, 1_000, 2_000, 300)
    resolved = t.select("trigger_id", F.col("attrs")["bucket"].alias("container"), F.col("attrs")["prefix"].alias("t_anchor"))
    levels = sorted({len(r[0]) for r in resolved.select("t_anchor").collect()})
    assert len(levels) > 250
    side, reach = listing_module._nested(inv, resolved, levels, True, BroadcastLimit())
    located = {(r[0], r[1], r[2]) for r in side.select("container", "full_path", "size").collect()}
    assert side.count() == len(located) == len({(k, n) for _, k, n in want})
    assert side.join(reach, ["container", "t_anchor"]).count() == len(want)
    plan = side._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_only_folders_of_triggered_containers_are_read(spark, tmp_path):
    """An inventory in folders by container: Spark prunes them by the triggers while the listing runs."""
    data = [(f"{c}", f"a/f{i}", i) for c in ["x", "y", "7", "a b/ü", *map(str, range(20, 60))] for i in range(5)] + [(None, "a/f", 1)]
    inv = write_manifest(files(spark, data), str(tmp_path / "m"))
    assert rows(inv.select("container", "full_path", "size")) == sorted(data, key=repr)
    t = triggers(spark, (1, {"bucket": "y", "prefix": "a/"}), (2, {"bucket": "7", "prefix": ""}), (3, {"bucket": "a b/ü", "prefix": "a/f1"}))
    for folder in (tmp_path / "m").glob("container=[2-5]*"):
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"not to be opened")
    got = match_triggers(stage(resolve_triggers(t, T), "resolved"), inv, T)
    assert len(got.collect()) == 11
    assert "dynamicpruning" in got._jdf.queryExecution().optimizedPlan().toString()


FEW = BroadcastLimit(rows=10)  # triggers do not fit, hashes of their places do


@pytest.mark.parametrize("prefixes", [True, False])
def test_nested_places_of_many_triggers_are_looked_up_before_the_shuffle(spark, prefixes):
    """More triggers than can be broadcast: only files at places that some trigger looks at are shuffled (F1)."""
    if prefixes:
        t, inv, want = nested_case(spark, 3, 120, 300, 20)
        what = T
    else:
        folders = [("", ""), ("x", "x"), ("x/y", "x/y"), ("x/y/x", "/x/y/x/"), ("x/y/x/y", "x/y/x/y"), ("x/y/x/y/x", "x/y/x/y/x"), ("z", "z")]
        paths = ["f0", "x/f1", "x/y/f2", "x/y/x/f3", "x/y/x/y/x/f4", "y/f5", "xy/f6"]
        t = triggers(spark, *[(i, {"bucket": "b", "prefix": p}) for i, (_, p) in enumerate(folders * 3)])
        inv = files(spark, [("b", p, 1) for p in paths])
        want = sorted(((i, p, 1) for i, (f, _) in enumerate(folders * 3) for p in paths if not f or p.startswith(f"{f}/")), key=repr)
        what = ListingTemplates(container="${bucket}", directory="${prefix}")
    limit = FEW if prefixes else BroadcastLimit(rows=2)
    got = list_for_triggers(t, inv, what, limit=limit)
    assert rows(got, "trigger_id", "full_path", "size") == want
    if prefixes:
        assert "_place" in got._jdf.queryExecution().optimizedPlan().toString()


def test_equal_triggers_share_one_listing(spark, monkeypatch):
    """1,000 triggers of four kinds: the inventory meets four listings, counts and writes take a row per listing and file (F9, F10, F13)."""
    t = triggers(spark, *[(i // 2 * 2 if i < 20 else i, {"bucket": "b" if i % 2 else "c", "prefix": "d/", "ff": " " if i % 4 < 2 else "[ab].*"}) for i in range(1_000)],
                 (None, {"bucket": "b", "prefix": "d/"}), (5_000, {"bucket": "b", "prefix": "d/", "ff": "["}))
    inv = files(spark, [("b", "d/a", 1), ("b", "d/x", 2), ("c", "d/b", 4), ("c", "e/b", 8)])
    resolved = resolve_triggers(t, T)
    shared = listing_module.match_listings(resolved, inv, T)
    assert shared.files.count() == 5 and shared.files.select("listing").distinct().count() == 4
    got = match_triggers(resolved, inv, T)
    asked = [(r.trigger_id, r.attrs) for r in t.collect() if r.attrs.get("ff") != "["]
    want = sorted(((i, r.full_path, r.size) for i, a in asked for r in inv.collect() if r.container == a["bucket"] and r.full_path.startswith("d/")
                   and (not (a.get("ff") or "").strip() or r.filename in "ab")), key=repr)
    assert rows(got, "trigger_id", "full_path", "size") == rows(shared.expanded(), "trigger_id", "full_path", "size") == want
    per = dict((i, (n, size)) for i, n, size in rows(shared.per_trigger("size"), "trigger_id", "n", "size"))
    assert per == {i: (sum(w[0] == i for w in want), sum(w[2] for w in want if w[0] == i)) for i, *_ in want}
    assert rows(match_triggers(resolved, inv, T, limit=NOTHING_FITS), "trigger_id", "full_path", "size") == want
    other = t.withColumn("attrs", F.map_concat("attrs", F.create_map(F.lit("own"), (F.col("trigger_id") % 3).cast("string"))))
    with_attrs = listing_module.match_listings(resolve_triggers(other, T), inv, T, with_attrs=True)
    own = rows(with_attrs.expanded().select("trigger_id", F.col("attrs")["own"], "full_path").where("trigger_id IS NOT NULL"))
    assert own == sorted(((i, str(i % 3), p) for i, p, _ in want if i is not None), key=repr)


def test_files_of_a_listing_with_many_triggers_are_dealt_to_more_tasks(spark):
    """Ten times the triggers for a listing: its files go to ten times the tasks, so no task grows with the triggers (F12)."""
    inv = files(spark, [("b", f"d/{i}", i) for i in range(40)])
    parts = []
    for n in (50, 500):
        t = spark.range(n).select(F.col("id").alias("trigger_id"), F.create_map(F.lit("bucket"), F.lit("b"), F.lit("prefix"), F.lit("d/")).alias("attrs"))
        got = match_triggers(resolve_triggers(t, T), inv, T)
        parts.append(got.rdd.getNumPartitions())
        assert got.count() == got.distinct().count() == 40 * n
    assert parts[1] == 10 * parts[0]


def test_triggers_of_a_listing_are_broadcast_as_one_row(spark):
    """A file is looked up once and its listing's triggers follow from one array; repeated, null and described triggers stay (F13)."""
    shared = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3), ("none", 4)], "listing string, size bigint")
    asked = [("k", 1, "x"), ("k", 1, "x"), ("k", None, None), ("k", None, "y"), ("m", 5, None), ("other", 6, "z")]
    askers = spark.createDataFrame(asked, "listing string, trigger_id bigint, note string")
    want = sorted(((k, size, t, n) for k, size in (("k", 1), ("k", 2), ("m", 3)) for o, t, n in asked if o == k), key=repr)
    for limit in (listing_module.DEFAULT_LIMIT, NOTHING_FITS):
        got = listing_module.for_askers(shared, askers, limit)
        assert got.columns == ["listing", "size", "trigger_id", "note"]
        assert rows(got) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("inline(" in plan) == (limit is not NOTHING_FITS)


def test_a_shared_listing_is_written_once(spark, tmp_path):
    """300 equal triggers: one folder with the files, and 300 rows that say who asked (F9)."""
    from tidemark.sources.sinks import write_shared_listing

    t = triggers(spark, *[(i, {"bucket": "b", "prefix": ""}) for i in range(300)])
    shared = listing_module.match_listings(resolve_triggers(t, T), files(spark, [("b", "a", 1), ("b", "x", 2)]), T)
    stored = write_shared_listing(shared, f"{tmp_path}/files", f"{tmp_path}/askers")
    assert len(list((tmp_path / "files").glob("listing=*"))) == 1 and stored.files.count() == 2
    assert rows(stored.per_trigger("size"), "trigger_id", "n", "size") == sorted(((i, 2, 3) for i in range(300)), key=repr)


def test_a_task_hands_out_few_listings(spark):
    """Files of listings with many triggers go to tasks listing by listing, in equal shares of the rows; what is derived from them comes after (F1 of round 4)."""
    shared = spark.createDataFrame([(f"k{i % 6}", i % 900, "x") for i in range(3_000)] + [("k6", 1, "x")] * 3 + [("unasked", 1, "x"), (None, 1, "x")],
                                   "listing string, size bigint, note string").repartition(5)
    asked = [(f"k{i % 7}", i) for i in range(1_400)] + [("k0", None), ("k0", 7), ("k0", 7), ("none", 1), (None, 2)]
    askers = spark.createDataFrame(asked, "listing string, trigger_id bigint")

    def doubled(files):
        assert files.columns == ["listing", "size", "note"]
        return files.select("listing", F.explode(F.array("size", F.lit(-1).cast("bigint"))).alias("value"))

    got = listing_module.for_askers(shared, askers, made=doubled)
    want = (shared.join(askers, "listing").select("listing", F.explode(F.array("size", F.lit(-1).cast("bigint"))).alias("value"), "trigger_id"))
    assert got.columns == ["listing", "value", "trigger_id"] and got.count() == want.count() and got.exceptAll(want).isEmpty()
    tasks = got.rdd.getNumPartitions()
    per = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("listing").alias("listings"), F.count(F.lit(1)).alias("n")).collect()
    assert max(r.listings for r in per) <= 3 and len(per) > tasks // 2 and max(r.n for r in per) < 4 * got.count() / tasks
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("explode") < text.index("RepartitionBy")  # above it in the plan
    assert listing_module.for_askers(shared, askers, NOTHING_FITS, doubled).exceptAll(want).isEmpty()
    nothing = listing_module.for_askers(shared.where("size < 0"), askers, made=doubled)
    assert nothing.isEmpty()
