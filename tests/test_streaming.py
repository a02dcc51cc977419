import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.listing import ListingTemplates
from tidemark.schema import MESSAGES
from tidemark.sources.messages import message_stream, trigger_stream
from tidemark.functions import target_attributes
from tidemark.streaming import (
    TriggeredListing, dedupe_messages, run_incremental_triggers, run_message_routes, run_triggered_listing, schedule,
)

T = ListingTemplates(container="${bucket}", file_filter="${ff}")


def land(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, records)))


def listing(spark, path, snapshot, partition_by=("trigger_id",)):
    run_triggered_listing(trigger_stream(spark, f"{path}/in"), snapshot, T, f"{path}/out", f"{path}/cp",
                          listing=F.create_map(F.lit("origin"), F.lit("listing"), F.lit("filename"), F.col("filename")),
                          partition_by=partition_by).awaitTermination()


@pytest.mark.parametrize("partition_by", [("trigger_id",), ()])
def test_triggers_are_consumed_once(spark, tmp_path, partition_by):
    def snapshot(s):
        return s.createDataFrame([("b", "d", "f.csv"), ("b", "d", "g.txt")], "container string, directory string, filename string") \
            .withColumn("full_path", F.concat_ws("/", "directory", "filename"))

    land(tmp_path / "in", "1.json", {"trigger_id": 1, "attrs": {"bucket": "b", "ff": r".*\.csv", "batch.id": "7", "origin": "trigger"}},
         {"trigger_id": 2, "attrs": {"bucket": "none"}}, {"trigger_id": 3, "attrs": {"bucket": "b", "ff": "["}})
    listing(spark, tmp_path, snapshot, partition_by)
    land(tmp_path / "in", "2.json", {"trigger_id": 4, "attrs": {"bucket": "b", "ff": " "}})
    listing(spark, tmp_path, snapshot, partition_by)  # a restart: the first triggers are not listed again
    listing(spark, tmp_path, snapshot, partition_by)  # no trigger, no listing

    def route(name):
        return spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out/batch_id=*/route={name}")

    assert rows(route("success"), "batch_id", "trigger_id", "full_path") == [(0, 1, "d/f.csv"), (1, 4, "d/f.csv"), (1, 4, "d/g.txt")]
    assert rows(route("no_files"), "batch_id", "trigger_id") == [(0, 2)]
    assert rows(route("failure"), "batch_id", "trigger_id") == [(0, 3)]
    attributes = route("success").where("trigger_id = 1").first()["attributes"]
    assert attributes == {"bucket": "b", "ff": r".*\.csv", "batch.id": "7", "origin": "listing", "filename": "f.csv"}


def message(i, body, at="2024-01-01T00:00:00Z"):
    return {"message_id": i, "received_at": at, "remote_address": "localhost:8080", "body": body}


def test_messages_and_acks(spark, tmp_path):
    land(tmp_path / "in", "1.json", message(1, '{"id":"a","event":"e"}'), message(2, "[1]"), message(3, "{bad"))
    run_message_routes(message_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/acks", f"{tmp_path}/cp").awaitTermination()
    land(tmp_path / "in", "2.json", message(4, '{"id":"b","event":"/e"}'))
    run_message_routes(message_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/acks", f"{tmp_path}/cp").awaitTermination()
    stored = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out/*")
    assert rows(stored, "message_id", "route", "body") == [
        (1, "text message", '{"id":"a","event":"e"}'), (2, "failure", "[1]"), (3, "text message", "{bad"),
        (4, "text message", '{"id":"b","event":"/e"}')]
    acks = spark.read.parquet(*[str(p) for p in (tmp_path / "acks").iterdir()])
    assert rows(acks, "message_id", "remote_address", "ack") == [(1, "localhost:8080", '{"event":"ack","msg":"a"}')]


def test_replays_are_dropped(spark, tmp_path):
    land(tmp_path / "in", "1.json", message(1, "a"), message(1, "a"), message(2, "b"))
    land(tmp_path / "in", "2.json", message(1, "a", "2024-01-01T00:05:00Z"))
    stream = dedupe_messages(spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in"))
    (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
     .trigger(**schedule(None)).start().awaitTermination())
    assert rows(spark.read.schema(MESSAGES).parquet(f"{tmp_path}/out"), "message_id") == [(1,), (2,)]


def test_schedule():
    assert schedule() == {"processingTime": "1 minute"} and schedule(None) == {"availableNow": True}


def snapshot_of(spark, *names_and_minutes):
    df = spark.createDataFrame(list(names_and_minutes), "filename string, minute int")
    return df.select(F.lit("b").alias("container"), F.lit("d").alias("directory"), "filename", F.concat(F.lit("d/"), "filename").alias("full_path"),
                     F.lit(1).cast("bigint").alias("size"), F.timestamp_millis(F.col("minute") * 60_000).alias("last_modified"),
                     F.lit(False).alias("is_directory"))


def asked(spark, *data):
    return spark.createDataFrame(list(data), "trigger_id bigint, attrs map<string,string>")


@pytest.mark.parametrize("tracking", ["timestamps", "entities"])
def test_triggered_listing_keeps_state_per_setting(spark, tmp_path, tracking):
    listing = TriggeredListing(spark, f"{tmp_path}/state", T, tracking, window_ms=10**12,
                               target=target_attributes("s3", F.col("t_container"), F.col("t_prefix")))
    one, two = snapshot_of(spark, ("a.csv", 1), ("b.txt", 2)), snapshot_of(spark, ("a.csv", 1), ("b.txt", 2), ("c.csv", 3))
    same = (1, {"bucket": "b", "ff": r".*\.csv"})

    def run(inv, version, *triggers):
        out = listing.run(asked(spark, *triggers), inv, version, f"{tmp_path}/out", 10**9)
        return [r[:3] for r in rows(out, "trigger_id", "route", "filename")], out

    first, out = run(one, 1, same, (2, {"bucket": "none", "x": "y"}), (3, {"bucket": "b", "ff": "["}))
    assert first == [(1, "success", "a.csv"), (2, "no_files", None), (3, "failure", None)]
    attrs = {r.trigger_id: r.attributes for r in out.collect()}
    assert attrs[2] == {"bucket": "none", "x": "y", "s3.bucket": "none", "record.count": "0", "mime.type": "application/parquet"}
    assert attrs[3]["error.message"] == "invalid pattern" and attrs[3]["s3.bucket"] == "b" and attrs[1] is None
    for _ in range(2):  # the second attempt gives the same rows
        assert run(two, 2, same, (4, {"bucket": "b", "ff": r".*\.csv"}))[0] == [(1, "success", "c.csv"), (4, "success", "c.csv")]
    assert run(two, 3, same)[0] == []  # all matches are old: no row at all
    assert run(two, 4, (1, {"bucket": "b", "ff": r".*\.(csv|txt)"}))[0] == [(1, "success", "a.csv"), (1, "success", "b.txt"), (1, "success", "c.csv")]


def test_a_listing_without_state_starts_at_its_floor(spark, tmp_path):
    listing = TriggeredListing(spark, f"{tmp_path}/state", T, initial="from_timestamp", initial_ms=2 * 60_000)
    inv = snapshot_of(spark, ("a", 1), ("b", 2), ("c", 3))
    out = listing.run(asked(spark, (1, {"bucket": "b"})), inv, 1, f"{tmp_path}/out", 10**9)
    assert rows(out, "filename") == [("b",), ("c",)]


def test_incremental_triggers_as_a_stream(spark, tmp_path):
    listing = TriggeredListing(spark, f"{tmp_path}/state", T)
    for number, names in enumerate(([("a", 1)], [("a", 1), ("b", 2)])):
        land(tmp_path / "in", f"{number}.json", {"trigger_id": number, "attrs": {"bucket": "b"}})
        run_incremental_triggers(trigger_stream(spark, f"{tmp_path}/in"), lambda s, n=names: snapshot_of(s, *n), listing,
                                 f"{tmp_path}/out", f"{tmp_path}/cp", lambda: 10**9).awaitTermination()
    assert [rows(spark.read.parquet(f"{tmp_path}/out/run={n}"), "trigger_id", "filename") for n in (0, 1)] == [[(0, "a")], [(1, "b")]]


@pytest.mark.parametrize("tracking", ["timestamps", "entities"])
def test_equal_triggers_share_what_a_run_writes(spark, tmp_path, tracking):
    """200 equal triggers: a run writes each new file once and counts it for all of them (F3, F4)."""
    listing = TriggeredListing(spark, f"{tmp_path}/state", T, tracking, window_ms=10**12, shared=True)
    same = [(i, {"bucket": "b", "ff": r".*\.csv"}) for i in range(200)]
    odd = [(200, {"bucket": "none"}), (201, {"bucket": "b", "ff": "["}), (202, {"bucket": "b"})]
    one = [("a.csv", 1), ("b.txt", 2)]

    def run(version, *names):
        out = listing.run(asked(spark, *same, *odd), snapshot_of(spark, *names), version, f"{tmp_path}/out", 10**9)
        return out.where("route = 'success'").count(), rows(listing.counts(f"{tmp_path}/out", version), "trigger_id", "route", "n")

    empty = [(200, "no_files", 1), (201, "failure", 1)]
    assert run(1, *one) == (3, sorted([*((i, "success", 1) for i in range(200)), *empty, (202, "success", 2)], key=repr))
    assert run(2, *one, ("c.csv", 3)) == (2, sorted([*((i, "success", 1) for i in range(200)), *empty, (202, "success", 1)], key=repr))
    assert run(3, *one, ("c.csv", 3)) == (0, sorted(empty, key=repr))


def test_a_batch_of_equal_triggers_is_written_once(spark, tmp_path):
    """100 equal triggers of a stream: two rows and one folder instead of 200 rows and 100 folders (F10)."""
    land(tmp_path / "in", "1.json", *[{"trigger_id": i, "attrs": {"bucket": "b"}} for i in range(100)], {"trigger_id": 100, "attrs": {"bucket": "x"}})
    run_triggered_listing(trigger_stream(spark, f"{tmp_path}/in"), lambda s: snapshot_of(s, ("a", 1), ("b", 2)), T, f"{tmp_path}/out",
                          f"{tmp_path}/cp", shared=True).awaitTermination()
    target = tmp_path / "out" / "batch_id=0"
    assert len(list((target / "route=success").glob("listing=*"))) == 1
    files, askers = spark.read.parquet(f"{target}/route=success"), spark.read.parquet(f"{tmp_path}/out/askers/batch_id=0")
    assert rows(files, "filename") == [("a",), ("b",)] and files.join(askers, "listing").count() == 200
    assert rows(spark.read.parquet(f"{target}/route=no_files")) == [(100,)]
