"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.predicates import FilterSpec, apply_filters
from tidemark.operators.incremental import TIMESTAMP_STATE, new_since
from tidemark.sources.inventory import read_manifest, scope


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def manifest(spark, tmp_path):
    path = f"{tmp_path}/manifest"
    spark.range(1000).select(
        F.concat(F.lit("b"), F.col("id") % 4).alias("bucket"), F.concat(F.lit("d/f"), "id").alias("key"), F.col("id").alias("size"),
        (F.col("id") * 1000).alias("last_modified_ms"), F.lit("e").alias("etag"), F.lit("STANDARD").alias("storeClass"),
    ).write.mode("overwrite").partitionBy("bucket").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def long_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_reach_the_scan_of_a_manifest(manifest, long_metadata):
    spec = FilterSpec(min_size=10, min_age="5 secs", min_timestamp=20_000, directories="keep")
    kept = apply_filters(scope(read_manifest(manifest, "s3", spec, 100_000), "b1", prefix="d/f1"), spec, 100_000)
    assert kept.count() == len([i for i in range(20, 96) if i % 4 == 1 and str(i).startswith("1")])
    text = plan(kept.select("full_path", "size"))
    assert "PartitionFilters: [isnotnull(bucket" in text
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "StringStartsWith(key,d/f1)" in pushed and "GreaterThanOrEqual(size,10)" in pushed
    assert "LessThanOrEqual(last_modified_ms,95000)" in pushed and "GreaterThanOrEqual(last_modified_ms,20000)" in pushed
    assert text.split("ReadSchema: ")[1].splitlines()[0] == "struct<key:string,size:bigint,last_modified_ms:bigint>"


def test_age_reaches_the_scan_of_a_timestamp_column(spark, tmp_path, long_metadata):
    spark.range(10).select(F.timestamp_seconds("id").alias("last_modified"), F.lit(False).alias("is_directory")).write.parquet(f"{tmp_path}/i")
    text = plan(apply_filters(spark.read.parquet(f"{tmp_path}/i"), FilterSpec(min_age="5 secs"), 9_000))
    assert "LessThanOrEqual(last_modified,1970-01-01" in text


def test_incremental_listing_does_not_shuffle_the_inventory(spark, tmp_path):
    inv = spark.range(1000).select(F.lit("c").alias("container"), F.col("id").cast("string").alias("full_path"),
                                   F.timestamp_seconds("id").alias("last_modified"))
    inv.write.parquet(f"{tmp_path}/inv")
    state = spark.createDataFrame([], TIMESTAMP_STATE)
    text = plan(new_since(spark.read.parquet(f"{tmp_path}/inv"), state))
    assert "SortMergeJoin" not in text
