"""Counts observed while a listing is written."""

from pyspark.sql import functions as F

from helpers import rows
from tidemark.catalog.files import LISTING
from tidemark.catalog.registry import NOW_MS
from tidemark.catalog.views import inventory
from tidemark.operators.predicates import FilterSpec, apply_filters
from tidemark.operators.summary import count_unfiltered, listing_summary, write_counted_listing


def test_one_write_brings_all_counts(spark, sf_dir, tmp_path):
    inv = inventory(spark, sf_dir)
    stored, counts = write_counted_listing(inv, LISTING, NOW_MS, f"{tmp_path}/out")
    total = inv.withColumn("container", F.lit("all"))
    want = count_unfiltered(total, LISTING, NOW_MS).first().asDict() | listing_summary(total, LISTING, NOW_MS).first().asDict()
    assert counts == {k: v for k, v in want.items() if k not in ("container", "filtered")}
    assert counts["files"] == want["filtered"] and counts["unfiltered"] > counts["before_patterns"] > counts["files"] > 0
    assert rows(stored, "doc_id") == rows(apply_filters(inv, LISTING, NOW_MS), "doc_id")


def test_the_inventory_is_scanned_once(spark, sf_dir, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def touched(_):
        runs.add(1)
        return True

    inv = inventory(spark, sf_dir).withColumn("is_directory", ~touched.asNondeterministic()("doc_id"))
    _, counts = write_counted_listing(inv, LISTING, NOW_MS, f"{tmp_path}/out")
    assert runs.value == counts["unfiltered"]


def test_empty_inventory_and_no_rules(spark, sf_dir, tmp_path):
    inv = inventory(spark, sf_dir)
    _, none = write_counted_listing(inv.limit(0), LISTING, NOW_MS, f"{tmp_path}/none")
    assert none["unfiltered"] == none["files"] == none["bytes"] == 0 and none["newest"] is None
    stored, counts = write_counted_listing(inv, FilterSpec(min_age=None, directories="keep"), NOW_MS, f"{tmp_path}/all", fmt="json")
    assert counts["files"] == counts["unfiltered"] == stored.count()
