"""Folders as a data source: lazy and pruned reads, writes that appear at commit."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringStartsWith

from helpers import rows
from tidemark.sources import datasource as S
from tidemark.sources.inventory import scan_inventory


@pytest.fixture
def tree(tmp_path):
    for i, path in enumerate(["f", "a/x", "a/b/y", "a/b/c/z", "ab/q", "d/_hidden", "d/.dot", "d/e/f g", "deep/1/2/3/4/5/x"]):
        full = tmp_path / "tree" / path
        full.parent.mkdir(parents=True, exist_ok=True)
        full.write_bytes(b"x" * i)
    (tmp_path / "tree" / "empty").mkdir()
    return str(tmp_path / "tree")


def shown(df):
    return rows(df, "provider", "container", "directory", "filename", "full_path", "size", "last_modified", "is_directory", "etag", F.map_entries("extra"))


@pytest.mark.parametrize("partitions", [1, 3, 64])
@pytest.mark.parametrize("directories", [True, False])
def test_equals_the_scan(spark, tree, partitions, directories):
    read = spark.read.format(S.register(spark)).option("partitions", partitions).option("with_directories", directories).load(tree)
    assert shown(read) == shown(scan_inventory(spark, tree, with_directories=directories))


def opened(reader):
    """Folders that planning and reading open, and the paths found."""
    seen, plain = [], S.FolderReader.open
    reader.open = lambda store, top, folder: seen.append(folder) or plain(reader, store, top, folder)
    parts = reader.partitions()
    planned, found = len(seen), [p for part in parts for b in reader.read(part) for p in b["full_path"].to_pylist()]
    return planned, set(seen), sorted(found)


def test_filters_reach_the_folders(tree):
    _, every, found = opened(S.FolderReader([tree], 2, False))
    assert len(every) == 14 and len(found) == 9
    reader = S.FolderReader([tree], 2, False)
    assert len(list(reader.pushFilters([StringStartsWith(("full_path",), "a/b")]))) == 1  # Spark still checks
    _, some, found = opened(reader)
    assert some == {"", "a", "a/b", "a/b/c"} and {"a/b/y", "a/b/c/z"} <= set(found)
    reader = S.FolderReader([tree, "/nowhere"], 2, False)
    list(reader.pushFilters([EqualTo(("container",), tree), EqualTo(("directory",), "deep/1")]))
    assert opened(reader)[1] == {"", "deep", "deep/1"} | {f"deep/1/{'/'.join('2345'[:n])}" for n in range(1, 5)}
    reader = S.FolderReader([tree], 2, False)
    list(reader.pushFilters([EqualTo(("container",), "other")]))
    assert opened(reader) == (0, set(), [])


def test_filtered_reads_and_roots(spark, tree, tmp_path):
    read = spark.read.format(S.register(spark)).option("roots", json.dumps([f"{tree}/a", f"{tree}/d", "/nowhere"])).load()
    some = read.where((F.col("container") == f"{tree}/a") & F.startswith("full_path", F.lit("b/")))
    assert rows(some, "full_path") == [("b/c/z",), ("b/y",)]  # "/nowhere" was not opened
    assert "StringStartsWith" in some._jdf.queryExecution().executedPlan().toString() or some.count() == 2


def test_files_appear_at_commit(spark, tmp_path):
    out, name = str(tmp_path / "out"), S.register(spark)
    df = spark.range(1_000).select("id", (F.col("id") * 2).alias("twice"), F.col("id").cast("string").alias("text"))
    df.repartition(5).write.format(name).mode("append").save(out)
    assert rows(spark.read.parquet(out)) == rows(df)
    assert all(n.startswith("part-") or n in ("_SUCCESS",) for n in os.listdir(out)) and len(os.listdir(out)) == 6
    df.limit(10).write.format(name).mode("overwrite").save(out)
    assert spark.read.parquet(out).count() == 10
    before = sorted(os.listdir(out))
    broken = df.repartition(5).withColumn("id", F.when(F.col("id") == 500, F.raise_error(F.lit("bad row")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad row|abort|Writing job"):
        broken.write.format(name).mode("append").save(out)
    assert sorted(os.listdir(out)) == before and spark.read.parquet(out).count() == 10
