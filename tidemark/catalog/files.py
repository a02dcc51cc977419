"""Queries over file inventories: predicates, scope, manifests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.catalog.registry import BASE_MS, NOW_MS, query
from tidemark.catalog.views import (
    SUPPLIER_LISTING, inventory, line_inventory, messages, supplier_triggers, table, text,
)
from tidemark.operators import predicates as p
from tidemark.operators.incremental import initial_floor
from tidemark.operators.listing import has_objects

from tidemark.sources.inventory import any_object, read_manifest, scope, union_providers

_COLUMNS = "container, directory, filename, size, last_modified_ms"


def _shape(df: DataFrame) -> DataFrame:
    return df.select("container", "directory", "filename", "size", F.unix_millis("last_modified").alias("last_modified_ms"))


def _predicate(name: str, rule: Callable[[], Column], condition: str) -> None:
    @query(name, f"SELECT {_COLUMNS} FROM inv WHERE {condition}", ("inv",))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shape(inventory(spark, sf_dir).where(rule()))


_predicate("min_age", lambda: p.min_age("1 hour", NOW_MS), f"{NOW_MS} - last_modified_ms >= 3600000")
_predicate("max_age", lambda: p.max_age("2 hours", NOW_MS), f"{NOW_MS} - last_modified_ms <= 7200000")
_predicate("min_size", lambda: p.min_size("0.5 KB"), "size >= 512")
_predicate("max_size", lambda: p.max_size("5 KB"), "size <= 5120")
_predicate("min_timestamp", lambda: p.min_timestamp(BASE_MS + 30_000_000), f"last_modified_ms >= {BASE_MS + 30_000_000}")
_predicate("file_filter", lambda: p.file_filter(r"doc_.*\.(csv|txt)"), r"regexp_full_match(filename, 'doc_.*\.(csv|txt)')")
_predicate("path_filter", lambda: p.path_filter("(en|fr)/.*", "data"),
           "regexp_full_match(regexp_replace(directory, '^data/?', ''), '(en|fr)/.*')")
_predicate("ignore_suffix", lambda: p.ignore_suffix(".tmp"), "NOT ends_with(filename, '.tmp')")
_predicate("exclude_temp", lambda: p.exclude_temp("/de/b3/"), "NOT contains(full_path, '/de/b3/')")
_predicate("exclude_directories", lambda: p.exclude_directories(), "NOT is_directory")
_predicate("ignore_dotted", lambda: p.ignore_dotted(), "NOT starts_with(filename, '.')")


@query("initial_timestamp", f"SELECT {_COLUMNS} FROM inv WHERE last_modified_ms >= {BASE_MS + 12_345_000}", ("inv",))
def _initial_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    floor = initial_floor("from_timestamp", state_empty=True, timestamp_ms=BASE_MS + 12_345_000)
    return _shape(inventory(spark, sf_dir).where(p.initial_timestamp(floor)))


@query("message_size", "SELECT doc_id, n_chars FROM documents WHERE strlen(text) <= 2000")
def _message_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(p.message_size(2_000, "text")).select("doc_id", "n_chars")


@query("topic_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def _topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(p.topic_filter("click, purchase", "event_type")).select("event_id", "event_type")


LISTING = p.FilterSpec(min_age="1 hour", min_size=500, max_size=5_000, file_filter=r"doc_.*\.(csv|txt)",
                       path_filter="(en|fr)/.*", path_base="data", ignore_suffix=".tmp")


@query("listing_filter", f"""SELECT {_COLUMNS}, is_directory, etag FROM inv
 WHERE NOT is_directory AND {NOW_MS} - last_modified_ms >= 3600000 AND size BETWEEN 500 AND 5000
 AND regexp_full_match(filename, 'doc_.*\\.(csv|txt)')
 AND regexp_full_match(regexp_replace(directory, '^data/?', ''), '(en|fr)/.*') AND NOT ends_with(filename, '.tmp')""", ("inv",))
def _listing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = p.apply_filters(inventory(spark, sf_dir), LISTING, NOW_MS)
    return kept.select("container", "directory", "filename", "size",
                       F.unix_millis("last_modified").alias("last_modified_ms"), "is_directory", "etag")


@query("listing_filter_pass_directories", f"""SELECT {_COLUMNS}, is_directory FROM inv
 WHERE (is_directory OR ({NOW_MS} - last_modified_ms BETWEEN 60000 AND 30000000 AND size BETWEEN 200 AND 3000))
 AND NOT starts_with(filename, '.')""", ("inv",))
def _listing_filter_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = p.FilterSpec(min_age="1 min", max_age="30000 secs", min_size=200, max_size=3_000, ignore_dotted=True,
                        directories="pass")
    kept = p.apply_filters(inventory(spark, sf_dir), spec, NOW_MS)
    return kept.select("container", "directory", "filename", "size",
                       F.unix_millis("last_modified").alias("last_modified_ms"), "is_directory")


@query("scope", f"""SELECT {_COLUMNS} FROM inv WHERE container = 'src1' AND (directory = 'data/en' OR starts_with(directory, 'data/en/'))""", ("inv",))
def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(scope(inventory(spark, sf_dir), "src1", "data/en"))


@query("scope_children", f"SELECT {_COLUMNS} FROM inv WHERE container = 'src1' AND directory = 'data/en/b3'", ("inv",))
def _scope_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(scope(inventory(spark, sf_dir), "src1", "data/en/b3", recursive=False))


@query("scope_prefix", f"SELECT {_COLUMNS} FROM inv WHERE starts_with(full_path, 'data/e')", ("inv",))
def _scope_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(scope(inventory(spark, sf_dir), prefix="data/e"))


@query("has_objects", """SELECT trigger_id, EXISTS (SELECT 1 FROM inv WHERE inv.container = sup.container
 AND starts_with(inv.full_path, sup.prefix)) AS has_objects FROM sup""", ("inv", "sup"))
def _has_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = has_objects(inventory(spark, sf_dir), supplier_triggers(spark, sf_dir), SUPPLIER_LISTING)
    return found.select("trigger_id", "has_objects")


@query("preflight", """SELECT container, count(*) AS files, bool_or(starts_with(full_path, 'data/en/b1')) AS found,
 (SELECT count(*) FROM inv WHERE container = 'src1' AND starts_with(full_path, 'data/en')) > 0 AS first_found FROM inv GROUP BY container""", ("inv",))
def _preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing's emptiness test, which reads at most one row, and the same test for every container."""
    inv = inventory(spark, sf_dir)
    there = scope(inv, prefix="data/en/b1").select("container", F.lit(True).alias("found")).distinct()
    counted = inv.groupBy("container").agg(F.count(F.lit(1)).alias("files")).join(there, "container", "left")
    return counted.withColumns({"found": F.coalesce("found", F.lit(False)), "first_found": F.lit(any_object(inv, "src1", "data/en"))})


def _s3_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_inventory(spark, sf_dir)
    return rows.select(F.col("container").alias("bucket"), F.col("full_path").alias("key"), "size",
                       F.unix_millis("last_modified").alias("last_modified_ms"),
                       F.md5("k").alias("etag"), F.lit("STANDARD").alias("storeClass"))


def _adls_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inventory(spark, sf_dir)
    return rows.select(F.col("container").alias("filesystem"), F.col("full_path").alias("file_path"),
                       F.col("size").alias("length"), F.unix_millis("last_modified").alias("last_modified_ms"),
                       "is_directory", "etag")


def _smb_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("smb://host"), text(F.col("o_custkey") % 9), F.lit(":445/share")).alias("service_location"),
                    F.concat(F.lit("orders/"), "o_orderstatus").alias("path"),
                    F.concat(F.lit("o"), text("o_orderkey"), F.lit(".dat")).alias("name"),
                    F.col("o_custkey").alias("size"), F.col("o_orderdate").alias("last_modified"),
                    F.lit(False).alias("directory"), F.concat(F.lit("O~"), text("o_orderkey")).alias("shortName"))


def _sftp_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("host"), text("c_nationkey")).alias("host"),
                    F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("cust/"), "c_mktsegment")).alias("path"),
                    F.concat(F.lit("c"), text("c_custkey"), F.lit(".txt")).alias("filename"),
                    F.col("c_custkey").alias("size"),
                    F.timestamp_millis(F.lit(BASE_MS) + F.col("c_custkey") * 1000).alias("last_modified"),
                    (F.col("c_custkey") % 11 == 0).alias("directory"), F.lit("rw-r--r--").alias("permissions"))


_MANIFESTS = {
    "s3": (_s3_manifest, """SELECT 's3' AS provider, container, directory, filename, concat(directory, '/', filename) AS full_path,
 size, epoch_ms(last_modified) AS last_modified_ms, false AS is_directory, md5(k) AS etag, 'STANDARD' AS detail FROM invl""", ("invl",), "storeClass"),
    "adls": (_adls_manifest, """SELECT 'adls' AS provider, container, directory, filename, full_path, size, last_modified_ms,
 is_directory, etag, CAST(NULL AS VARCHAR) AS detail FROM inv""", ("inv",), "none"),
    "smb": (_smb_manifest, """SELECT 'smb' AS provider, concat('smb://host', o_custkey % 9, ':445/share') AS container,
 concat('orders/', o_orderstatus) AS directory, concat('o', o_orderkey, '.dat') AS filename,
 concat('orders/', o_orderstatus, '/o', o_orderkey, '.dat') AS full_path, o_custkey AS size,
 epoch_ms(o_orderdate) AS last_modified_ms, false AS is_directory, CAST(NULL AS VARCHAR) AS etag,
 concat('O~', o_orderkey) AS detail FROM orders""", (), "shortName"),
    "sftp": (_sftp_manifest, f"""SELECT 'sftp' AS provider, concat('host', c_nationkey) AS container,
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('cust/', c_mktsegment) END AS directory,
 concat('c', c_custkey, '.txt') AS filename,
 CASE WHEN c_custkey % 3 = 0 THEN concat('c', c_custkey, '.txt')
  ELSE concat('cust/', c_mktsegment, '/c', c_custkey, '.txt') END AS full_path,
 c_custkey AS size, {BASE_MS} + c_custkey * 1000 AS last_modified_ms, c_custkey % 11 = 0 AS is_directory,
 CAST(NULL AS VARCHAR) AS etag, 'rw-r--r--' AS detail FROM customer""", (), "permissions"),
}


def _flat(inv: DataFrame) -> DataFrame:
    detail = F.coalesce(*[F.col("extra")[k] for k in ("storeClass", "shortName", "permissions")])
    return inv.select("provider", "container", "directory", "filename", "full_path", "size",
                      F.unix_millis("last_modified").alias("last_modified_ms"), "is_directory", "etag", detail.alias("detail"))


def _manifest(provider: str) -> None:
    make, sql, views, _ = _MANIFESTS[provider]

    @query(f"read_manifest_{provider}", sql, views)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(read_manifest(make(spark, sf_dir), provider))


for _provider in _MANIFESTS:
    _manifest(_provider)


@query("union_providers", " UNION ALL ".join(m[1] for m in _MANIFESTS.values()), ("inv", "invl"))
def _union_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(union_providers(*[read_manifest(m[0](spark, sf_dir), name) for name, m in _MANIFESTS.items()]))


@query("read_messages", """SELECT message_id, body, octet_length(encode(body)) AS bytes,
 concat('10.0.0.', user_id % 256, ':8080') AS remote_address FROM msg JOIN events ON message_id = event_id""", ("msg",))
def _read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.messages import read_messages

    rows = read_messages(messages(spark, sf_dir).drop("event_type"), remote_address="unknown")
    return rows.select("message_id", "body", F.octet_length("body").cast("bigint").alias("bytes"), "remote_address")


@query("read_triggers", """SELECT o_orderkey AS trigger_id, 'status' AS name, o_orderstatus AS value FROM orders
 UNION ALL SELECT o_orderkey, 'bucket', concat('b', o_custkey % 50) FROM orders WHERE o_custkey % 4 <> 0""")
def _read_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.messages import read_triggers

    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trigger_id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("b"), text(F.col("o_custkey") % 50))).alias("bucket"))
    return read_triggers(rows).select("trigger_id", F.explode("attrs").alias("name", "value"))
