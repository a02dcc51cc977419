import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.routes import route_message

from tidemark.operators import predicates as p
from tidemark.operators.validate import validate_triggers
from tidemark.sources.inventory import any_object, scope

NOW = 1_704_067_200_000


@pytest.fixture(scope="module")
def inv(spark):
    data = [("c", "data/en", "a.txt", 100, 1000, False), ("c", "data/en/x", ".b.csv", 200, 2000, False),
            ("c", "data", "c.tmp", 300, 3000, False), ("d", "", "export.done", 400, 4000, False), ("c", "data", "sub", 0, 5000, True)]
    df = spark.createDataFrame(data, "container string, directory string, filename string, size bigint, age bigint, is_directory boolean")
    return df.withColumn("last_modified", F.timestamp_millis(F.lit(NOW) - F.col("age"))) \
             .withColumn("full_path", F.concat_ws("/", F.nullif("directory", F.lit("")), "filename"))


def names(df):
    return [r[0] for r in rows(df, "filename")]


def test_bounds_are_inclusive(inv):
    assert names(inv.where(p.min_age(3000, NOW))) == ["c.tmp", "export.done", "sub"]
    assert names(inv.where(p.min_age(3001, NOW))) == ["export.done", "sub"]
    assert names(inv.where(p.max_age("2 secs", NOW))) == [".b.csv", "a.txt"]
    assert names(inv.where(p.min_size(300))) == ["c.tmp", "export.done"]
    assert names(inv.where(p.max_size(200))) == [".b.csv", "a.txt", "sub"]
    assert names(inv.where(p.min_timestamp(NOW - 2000))) == [".b.csv", "a.txt"]
    assert names(inv.where(p.min_size(299.5) & p.max_size(300.5))) == ["c.tmp"]


def test_names(inv):
    assert names(inv.where(p.file_filter("^export.done"))) == ["export.done"]
    assert names(inv.where(p.file_filter("export"))) == []
    assert names(inv.where(p.path_filter("en(/.*)?", "data"))) == [".b.csv", "a.txt"]
    assert names(inv.where(p.path_filter("data/en"))) == ["a.txt"]
    assert "c.tmp" not in names(inv.where(p.ignore_suffix(".tmp")))
    assert ".b.csv" not in names(inv.where(p.ignore_dotted()))
    assert names(inv.where(p.exclude_temp("/en/"))) == ["c.tmp", "export.done", "sub"]


def test_directories(inv):
    big = p.FilterSpec(min_age=None, min_size=300)
    assert names(p.apply_filters(inv, big, NOW)) == ["c.tmp", "export.done"]
    passing = p.FilterSpec(min_age=None, min_size=300, directories="pass")
    assert names(p.apply_filters(inv, passing, NOW)) == ["c.tmp", "export.done", "sub"]


def test_default_minimum_age_is_five_seconds(inv):
    assert names(p.apply_filters(inv, p.FilterSpec(directories="keep"), NOW)) == ["sub"]


def test_blank_filters_are_off(inv):
    spec = p.FilterSpec(min_age=None, file_filter="  ", path_filter="")
    assert set(spec.rules(NOW)) == {"directories"}


def test_scope(inv):
    assert names(scope(inv, "c", "data/en")) == [".b.csv", "a.txt"]
    assert names(scope(inv, "c", "data/e")) == []
    assert names(scope(inv, "c", prefix="data/e")) == [".b.csv", "a.txt"]
    assert names(scope(inv, "c", "data/en", recursive=False)) == ["a.txt"]
    assert names(scope(inv, "c", prefix="data/", recursive=False)) == ["c.tmp", "sub"]
    assert names(scope(inv, recursive=False)) == ["export.done"]
    assert any_object(inv, "c", "") and any_object(inv, "c", None) and not any_object(inv, "c", "zz")
    assert not any_object(inv, "c", " ")  # a blank prefix is a prefix


def test_topics(spark):
    df = spark.createDataFrame([("a.b",), ("c",), ("ab",)], "event string")
    assert [r[0] for r in rows(df.where(p.topic_filter("a.b , c")))] == ["a.b", "c"]


def test_validation(spark):
    bad = spark.createDataFrame(
        [(1, "[", None, False, ".t/mp", True, False, "2025-02-01", " ", "s", "0", 0),
         (2, "te.*", "d.*", True, ".tmp", True, True, "2025-02-01T00:00:00Z", "h", "s", "445", 100),
         (3, "${x}[", "d.*", False, None, False, False, None, "h", "s", "65536", -1),
         (4, "", None, True, None, False, False, None, "h", "s", "22", 1)],
        "id int, file_filter string, path_filter string, recursive boolean, ignore_suffix string, has_user boolean, "
        "has_password boolean, initial_timestamp string, host string, share string, port string, batch_size int")
    got = {r["id"]: r for r in validate_triggers(bad).collect()}
    assert got[1]["errors"] == [
        "file_filter is not a valid pattern", "ignore_suffix holds a separator", "password is missing",
        "initial_timestamp is malformed", "host is blank", "port is out of range", "batch_size is not positive"]
    assert got[2]["errors"] == [] and got[2]["is_valid"]
    assert got[3]["errors"] == ["path_filter needs recursion", "port is out of range", "batch_size is not positive"]
    assert got[4]["is_valid"]


def test_topics_drop_only_messages_of_another_topic(spark):
    bodies = ['{"id":"1","event":"click"}', '{"id":"2","event":"buy"}', "{bad", "", '{"id":"3","event":"click","x":"' + "y" * 50 + '"}',
              '{"id":"4"}', None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "message_id int, body string")
    got = rows(route_message(df, limit=40, topics="click"), "message_id", "route")
    assert [m for m, _ in got] == [0, 2, 3, 4, 5, 6]
    assert dict(got)[0] != "failure" and dict(got)[4] == "failure"
