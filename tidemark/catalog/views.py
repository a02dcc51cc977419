"""Inventories, triggers, messages and write requests derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.catalog.registry import BASE_MS
from tidemark.operators.listing import ListingTemplates
from tidemark.schema import ATTRS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a data lake."""
    suffix = F.array(*[F.lit(s) for s in (".csv", ".txt", ".json", ".tmp", ".done")])
    n = F.col("doc_id")
    directory = F.concat(F.lit("data/"), "lang", F.lit("/b"), text(n % 7))
    filename = F.concat(F.when(n % 31 == 0, ".").otherwise(""), F.lit("doc_"), text(n),
                        F.get(suffix, (n % 5).cast("int")))
    return table(spark, sf_dir, "documents").select(
        F.lit("adls").alias("provider"), F.col("source").alias("container"),
        directory.alias("directory"), filename.alias("filename"),
        F.concat(directory, F.lit("/"), filename).alias("full_path"),
        F.col("n_chars").alias("size"),
        F.timestamp_millis(F.lit(BASE_MS) + (n * 60_000) % 60_000_000).alias("last_modified"),
        (n % 97 == 0).alias("is_directory"), F.md5("text").alias("etag"),
        F.create_map().cast(ATTRS).alias("extra"), n.alias("doc_id"))


def line_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as files of a file share; ``k`` is unique per row."""
    suffix = F.array(*[F.lit(s) for s in (".csv", ".txt", ".json", ".tmp")])
    directory = F.concat(F.lit("data/"), "l_returnflag", F.lit("/"), "l_linestatus")
    stem = F.concat(F.lit("f"), text("l_orderkey"), F.lit("_"), text("l_linenumber"))
    filename = F.concat(stem, F.get(suffix, (F.col("l_partkey") % 4).cast("int")))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("c"), text(F.col("l_suppkey") % 20)).alias("container"),
        directory.alias("directory"), filename.alias("filename"),
        F.concat(directory, F.lit("/"), filename).alias("full_path"),
        (F.col("l_quantity") * 1000).cast("bigint").alias("size"),
        F.col("l_shipdate").cast("timestamp").alias("last_modified"),
        F.lit(False).alias("is_directory"),
        F.concat_ws("/", directory, stem, text("l_partkey"), text("l_suppkey")).alias("k"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages that take every branch of the routing table."""
    n, e = text("event_id"), F.col("event_type")
    kind = F.col("event_id") % 10
    body = (F.when(kind == 0, F.lit("{bad"))
            .when(kind == 1, F.concat(F.lit('{"event":"'), e, F.lit('"}')))
            .when(kind == 2, F.concat(F.lit('{"id":"'), n, F.lit('"}')))
            .when(kind == 3, F.concat(F.lit('{"id":"'), n, F.lit('","event":"/sys/'), e, F.lit('"}')))
            .when(kind == 4, F.lit("[1]"))
            .when(kind == 5, F.concat(F.lit('{"id":null,"event":"'), e, F.lit('"}')))
            .when(kind == 6, F.lit(""))
            .otherwise(F.concat(F.lit('{"id":"'), n, F.lit('","event":"'), e, F.lit('","msg":'), "props", F.lit("}"))))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"), F.col("ts").cast("timestamp").alias("received_at"),
        F.concat(F.lit("10.0.0."), text(F.col("user_id") % 256), F.lit(":8080")).alias("remote_address"),
        body.alias("body"), "event_type")


def nation_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    ff = F.when(n % 4 == 0, ".*[.]csv").when(n % 4 == 1, "").when(n % 4 == 2, "   ").otherwise("nomatch")
    attrs = F.create_map(F.lit("bucket"), F.concat(F.lit("c"), text(n)), F.lit("filter"), ff,
                         F.lit("batch.id"), F.col("n_name"), F.lit("origin"), F.lit("trigger"))
    return table(spark, sf_dir, "nation").select(n.alias("trigger_id"), attrs.alias("attrs"))


NATION_LISTING = ListingTemplates(container="${bucket}", file_filter="${filter}")


def supplier_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triggers with prefixes of several depths, some of them without any object."""
    n = F.col("s_suppkey")
    tail = (F.when(n % 5 == 0, "en").when(n % 5 == 1, "fr/b1").when(n % 5 == 2, "de/b")
            .when(n % 5 == 3, "xx").otherwise(""))
    ff = F.when(n % 3 == 0, ".*[.]csv").when(n % 3 == 1, " ").otherwise("doc_[0-9]*1.*")
    attrs = F.create_map(F.lit("bucket"), F.concat(F.lit("src"), text(n % 24)),
                         F.lit("prefix"), F.concat(F.lit("data/"), tail), F.lit("filter"), ff)
    return table(spark, sf_dir, "supplier").select(n.alias("trigger_id"), attrs.alias("attrs"))


SUPPLIER_LISTING = ListingTemplates(container="${bucket}", prefix="${prefix}", file_filter="${filter}")


def order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute map per order, with a missing, a blank and some real values."""
    n = F.col("o_orderkey")
    ff = (F.when(n % 5 == 0, "").when(n % 5 == 1, "  ").when(n % 5 == 2, "\t ")
          .when(n % 5 == 3, "te.*"))
    pairs = F.create_map(F.lit("bucket"), F.concat(F.lit("b"), text(F.col("o_custkey") % 50)),
                         F.lit("status"), F.col("o_orderstatus"), F.lit("prio"), F.col("o_orderpriority"),
                         F.lit("ff"), ff)
    attrs = F.map_filter(pairs, lambda _, v: v.isNotNull())
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.when(n % 7 != 0, attrs).alias("attrs"), ff.alias("ff"))


ORDER_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def write_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as write requests.

    ``seq`` is a number made of the order keys; it follows them only while they
    are small (parts below 100,000, suppliers below 1,000).  ``place`` always
    does; it is null where ``seq`` is.
    """
    rows = line_inventory(spark, sf_dir)
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")
    seq = (key * 1_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("bigint")
    kind = F.col("l_suppkey") % 3
    return rows.select(
        seq.alias("seq"), F.col("container").alias("host"), F.lit("share").alias("share"), "directory", "filename",
        F.when(kind == 0, "replace").when(kind == 1, "ignore").otherwise("fail").alias("conflict"),
        F.col("full_path").alias("dest"), F.col("directory").alias("dest_dir"),
        "last_modified", *ORDER_KEYS, F.when(seq.isNotNull(), F.struct(*ORDER_KEYS)).alias("place"))


def key_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as objects whose keys begin like their texts, so that many have long heads in common."""
    head = F.substring(F.coalesce("text", F.lit("")), 1, 400)
    key = F.concat(F.lit("keys/"), "lang", F.lit("/"), head, F.lit("/"), text("doc_id"))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("container"), F.lit("keys").alias("directory"), text("doc_id").alias("filename"),
        key.alias("full_path"), F.col("n_chars").alias("size"), F.lit(False).alias("is_directory"), "doc_id")


def head_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for the objects that begin like the one of its number, by prefixes of hundreds of lengths."""
    keys = key_inventory(spark, sf_dir).select(F.col("doc_id").alias("c_custkey"), "container", "full_path")
    head = F.substring(F.col("full_path"), F.lit(1), (F.col("c_custkey") * 7 % 300 + 5).cast("int"))
    attrs = F.create_map(F.lit("bucket"), F.col("container"), F.lit("prefix"), head, F.lit("filter"), F.lit(""))
    return table(spark, sf_dir, "customer").join(keys, "c_custkey").select(F.col("c_custkey").alias("trigger_id"), attrs.alias("attrs"))


def pattern_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for files by a name pattern of its own; some patterns say hardly anything."""
    n = F.col("c_custkey")
    own = F.concat(F.lit("f"), text(n), F.lit("_[0-9]*[.](csv|txt)"))
    attrs = F.create_map(F.lit("bucket"), F.concat(F.lit("c"), text(n % 20)), F.lit("filter"),
                         F.when(n % 200 == 0, F.concat(F.lit("[a-z].{"), text(n % 7), F.lit(",}"))).otherwise(own))
    return table(spark, sf_dir, "customer").select(n.alias("trigger_id"), attrs.alias("attrs"))
