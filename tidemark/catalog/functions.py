"""Queries over the scalar functions and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import functions as fn
from tidemark.catalog.registry import query
from tidemark.catalog.views import inventory, line_inventory, order_attributes, table, text
from tidemark.operators.listing import error_rows
from tidemark.operators.validate import validate_triggers

_ORDER = """SELECT *, concat('b', o_custkey % 50) AS bucket,
 CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN concat(chr(9), ' ') WHEN 3 THEN 'te.*' END AS ff,
 o_orderkey % 7 = 0 AS untriggered FROM orders"""


@query("render_template", f"""SELECT o_orderkey, CASE WHEN untriggered THEN '/in//x-' ELSE
 concat(bucket, '/in/', o_orderstatus, '/x-', o_orderpriority) END AS rendered FROM ({_ORDER}) o""")
def _render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_attributes(spark, sf_dir)
    return rows.select("o_orderkey", fn.render("${bucket}/in/${status}/${nothing}x-${prio}", F.col("attrs")).alias("rendered"))


@query("render_template_column", f"""SELECT o_orderkey, CASE o_orderkey % 4
 WHEN 0 THEN CASE WHEN untriggered THEN '/' ELSE concat(bucket, '/', o_orderstatus) END WHEN 1 THEN 'plain'
 WHEN 2 THEN '--' ELSE 'a${{prio' END AS rendered FROM ({_ORDER}) o""")
def _render_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 4
    template = (F.when(n == 0, F.lit("${bucket}/${status}")).when(n == 1, "plain")
                .when(n == 2, F.lit("-${nothing}-")).otherwise(F.lit("a${prio")))
    return order_attributes(spark, sf_dir).select("o_orderkey", fn.render_column(template, F.col("attrs")).alias("rendered"))


@query("blank_as_null", f"""SELECT o_orderkey, CASE WHEN regexp_full_match(ff, '\\s*') THEN NULL ELSE ff END AS value FROM ({_ORDER}) o""")
def _blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_attributes(spark, sf_dir).select("o_orderkey", fn.blank_as_null(F.col("ff")).alias("value"))


@query("resolve_filter", f"""SELECT o_orderkey,
 CASE WHEN untriggered THEN 'p_' ELSE concat('p_', coalesce(ff, '')) END AS prefixed,
 CASE WHEN untriggered OR o_orderkey % 5 <> 3 THEN NULL ELSE ff END AS plain,
 CASE WHEN untriggered THEN NULL ELSE concat('p_', coalesce(ff, '')) END AS ignored FROM ({_ORDER}) o""")
def _resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("attrs")
    return order_attributes(spark, sf_dir).select(
        "o_orderkey", fn.resolve_filter("p_${ff}", a).alias("prefixed"), fn.resolve_filter("${ff}", a).alias("plain"),
        fn.resolve_filter("p_${ff}", a, no_trigger="ignore").alias("ignored"))


@query("merge_attributes", f"""SELECT o_orderkey, 'origin' AS name, 'listing' AS value FROM orders
 UNION ALL SELECT o_orderkey, 'filename', concat('f', o_orderkey) FROM orders
 UNION ALL SELECT o_orderkey, 'batch.id', o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0""")
def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_attributes(spark, sf_dir)
    trigger = F.when(F.col("attrs").isNotNull(), F.create_map(
        F.lit("origin"), F.lit("trigger"), F.lit("batch.id"), F.col("o_orderpriority")))
    listing = F.create_map(F.lit("origin"), F.lit("listing"), F.lit("filename"), F.concat(F.lit("f"), text("o_orderkey")))
    return rows.select("o_orderkey", F.explode(fn.merge_attributes(trigger, listing)).alias("name", "value"))


_PATH = """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '/' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN concat('\\', lang, '\\b', doc_id % 7)
 WHEN 4 THEN concat('/', lang, '/b', doc_id % 7) ELSE concat(lang, '\\b', doc_id % 7) END AS p FROM documents"""


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("doc_id"), text(F.col("doc_id") % 7)
    p = (F.when(n % 6 == 0, "/").when(n % 6 == 1, F.lit(None)).when(n % 6 == 2, "")
         .when(n % 6 == 3, F.concat(F.lit("\\"), "lang", F.lit("\\b"), k))
         .when(n % 6 == 4, F.concat(F.lit("/"), "lang", F.lit("/b"), k)).otherwise(F.concat("lang", F.lit("\\b"), k)))
    return table(spark, sf_dir, "documents").select("doc_id", p.alias("p"))


@query("normalise_path", f"""SELECT doc_id, CASE WHEN p IS NULL OR p = '/' THEN '' ELSE replace(p, '\\', '/') END AS path,
 CASE WHEN p IS NULL OR p = '/' THEN '' ELSE regexp_replace(replace(p, '\\', '/'), '^/', '') END AS relative FROM ({_PATH}) x""")
def _normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("doc_id", fn.normalise_path(F.col("p")).alias("path"),
                                        fn.normalise_path(F.col("p"), relative=True).alias("relative"))


@query("join_path", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE l_partkey % 4 WHEN 0 THEN filename WHEN 1 THEN concat(directory, '/', filename) WHEN 2 THEN concat('/', filename)
  ELSE concat('/', directory, '/', filename) END AS joined,
 CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN directory WHEN 2 THEN '/' ELSE concat('/', directory) END AS parent,
 CASE l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat('data|data/', split_part(directory, '/', 2), '|', directory)
  WHEN 2 THEN '/' ELSE concat('/|/data|/data/', split_part(directory, '/', 2), '|/', directory) END AS ancestors FROM invl""", ("invl",))
def _join_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_partkey") % 4
    d = (F.when(n == 0, F.lit(" ")).when(n == 1, F.concat("directory", F.lit("/"))).when(n == 2, F.lit("/"))
         .otherwise(F.concat(F.lit("/"), "directory")))
    joined = fn.join_path(d, F.col("filename"))
    rows = line_inventory(spark, sf_dir).withColumn("joined", joined).withColumn("parent", fn.parent(F.col("joined")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "joined", "parent",
                       F.array_join(fn.ancestors(F.col("parent")), "|").alias("ancestors"))


@query("relative_dir", """SELECT doc_id, regexp_replace(directory, '^data/?', '') AS below_data,
 regexp_replace(directory, '^da/?', '') AS below_da, regexp_replace(directory, '^xx/?', '') AS below_xx FROM inv""", ("inv",))
def _relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("directory")
    return inventory(spark, sf_dir).select("doc_id", fn.relative_dir(d, "data").alias("below_data"),
                                           fn.relative_dir(d, "da").alias("below_da"), fn.relative_dir(d, "xx").alias("below_xx"))


@query("service_uri", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('smb://h', l_suppkey % 9, ':', 445 + l_suppkey % 2, '/share') AS service,
 concat('smb://h', l_suppkey % 9, ':', 445 + l_suppkey % 2, '/share/', CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat(directory, '/') END) AS display,
 concat('smb://h', l_suppkey % 9, ':', 445 + l_suppkey % 2, '/share/', directory, '/',
  CASE WHEN l_partkey % 2 = 0 THEN concat('a%20b%231%25_', filename) ELSE filename END) AS uri FROM invl""", ("invl",))
def _service_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = fn.service_uri(F.concat(F.lit("h"), text(F.col("l_suppkey") % 9)), F.lit(445) + F.col("l_suppkey") % 2, F.lit("share"))
    name = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("a b#1%_"), "filename")).otherwise(F.col("filename"))
    path = F.concat(F.lit("\\"), F.replace(F.col("directory"), F.lit("/"), F.lit("\\")), F.lit("\\"), name)
    shown = F.when(F.col("l_partkey") % 3 == 0, F.lit("/")).otherwise(F.col("directory"))
    return line_inventory(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", service.alias("service"),
        fn.display_path(service, shown).alias("display"), fn.transit_uri(service, path).alias("uri"))


_CODE = "CASE l_partkey % 5 WHEN 0 THEN 3221225487 WHEN 1 THEN 3221225524 WHEN 2 THEN 3221225530 WHEN 3 THEN 3221225506 END"


def error_code() -> Column:
    n = F.col("l_partkey") % 5
    return (F.when(n == 0, F.lit(3_221_225_487)).when(n == 1, F.lit(3_221_225_524))
            .when(n == 2, F.lit(3_221_225_530)).when(n == 3, F.lit(3_221_225_506)))


@query("classify_error", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE WHEN l_partkey % 5 < 3 THEN 'not found' ELSE 'failure' END AS kind, coalesce(CAST({_CODE} AS VARCHAR), '-2') AS code FROM lineitem""")
def _classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_inventory(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.classify_error(error_code()).alias("kind"), fn.error_code_text(error_code()).alias("code"))


@query("parse_initial_timestamp", """WITH x AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5
 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN CAST(epoch_ms(o_orderdate) AS VARCHAR)
 WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.25Z') ELSE o_orderpriority END AS s FROM orders)
 SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN epoch_ms(o_orderdate) WHEN 1 THEN epoch_ms(o_orderdate)
 WHEN 3 THEN epoch_ms(o_orderdate) + 250 END AS ms,
 CASE WHEN o_orderkey % 5 IN (2, 4) THEN concat('''', s, ''' is neither an epoch timestamp nor a UTC datetime.') END AS error FROM x""")
def _initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, ts = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("timestamp")
    s = (F.when(n == 0, F.concat(fn.iso_seconds(ts), F.lit("Z"))).when(n == 1, text(F.unix_millis(ts)))
         .when(n == 2, F.date_format(ts, "yyyy-MM-dd")).when(n == 3, F.concat(fn.iso_seconds(ts), F.lit(".25Z")))
         .otherwise(F.col("o_orderpriority")))
    parsed = order_attributes(spark, sf_dir).select("o_orderkey", s.alias("s")) \
        .select("o_orderkey", fn.parse_initial_timestamp(F.col("s")).alias("p"))
    return parsed.select("o_orderkey", "p.ms", "p.error")


@query("to_attributes", f"""WITH x AS (SELECT doc_id, container, directory, filename, full_path, size, last_modified_ms, etag FROM inv)
 SELECT doc_id, 'adls' AS provider, 'azure.filesystem' AS name, container AS value FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.filePath', full_path FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.directory', directory FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.filename', filename FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.length', CAST(size AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.lastModified', CAST(last_modified_ms AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 'adls', 'azure.etag', etag FROM x
 UNION ALL SELECT doc_id, 'smb', 'filename', filename FROM x
 UNION ALL SELECT doc_id, 'smb', 'path', directory FROM x
 UNION ALL SELECT doc_id, 'smb', 'serviceLocation', container FROM x
 UNION ALL SELECT doc_id, 'smb', 'size', CAST(size AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 'smb', 'lastModifiedTime', strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%dT%H:%M:%S') FROM x
 UNION ALL SELECT doc_id, 's3', 'filename', full_path FROM x
 UNION ALL SELECT doc_id, 's3', 's3.bucket', container FROM x
 UNION ALL SELECT doc_id, 's3', 's3.etag', etag FROM x
 UNION ALL SELECT doc_id, 's3', 's3.lastModified', CAST(last_modified_ms AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 's3', 's3.length', CAST(size AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 'sftp', 'filename', filename FROM x
 UNION ALL SELECT doc_id, 'sftp', 'path', directory FROM x
 UNION ALL SELECT doc_id, 'sftp', 'sftp.remote.host', container FROM x
 UNION ALL SELECT doc_id, 'sftp', 'file.size', CAST(size AS VARCHAR) FROM x
 UNION ALL SELECT doc_id, 'sftp', 'file.lastModifiedTime', strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%dT%H:%M:%S+0000') FROM x""", ("inv",))
def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = F.array(*[F.struct(F.lit(p).alias("provider"), fn.to_attributes(p).alias("attrs")) for p in ("adls", "smb", "s3", "sftp")])
    per_provider = inventory(spark, sf_dir).select("doc_id", F.inline(maps))
    return per_provider.select("doc_id", "provider", F.explode("attrs").alias("name", "value"))


@query("parse_size_duration", """SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN (o_custkey + 0.5) * 1024 WHEN 1 THEN o_custkey * 1048576.0
 WHEN 2 THEN o_custkey * 1.0 END AS DOUBLE) AS bytes,
 CASE o_orderkey % 5 WHEN 0 THEN o_custkey * 1000 WHEN 1 THEN o_custkey * 60000 WHEN 2 THEN o_custkey * 86400000 WHEN 3 THEN o_custkey END AS ms FROM orders""")
def _quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, m, k = F.col("o_orderkey") % 4, F.col("o_orderkey") % 5, text("o_custkey")
    size = (F.when(n == 0, F.concat(k, F.lit(".5 KB"))).when(n == 1, F.concat(k, F.lit("mb")))
            .when(n == 2, F.concat(k, F.lit(" B"))).otherwise(F.concat(k, F.lit(" parsecs"))))
    length = (F.when(m == 0, F.concat(k, F.lit(" secs"))).when(m == 1, F.concat(k, F.lit(" min")))
              .when(m == 2, F.concat(k, F.lit("d"))).when(m == 3, F.concat(k, F.lit(" millis"))).otherwise(F.lit("soon")))
    return order_attributes(spark, sf_dir).select("o_orderkey", fn.parse_size(size).alias("bytes"), fn.parse_duration(length).alias("ms"))


@query("target_attributes", f"""SELECT o_orderkey, 's3.bucket' AS name, bucket AS value FROM ({_ORDER}) o WHERE NOT untriggered
 UNION ALL SELECT o_orderkey, 's3.bucket', '' FROM ({_ORDER}) o WHERE untriggered
 UNION ALL SELECT o_orderkey, 's3.prefix', o_orderstatus FROM orders WHERE o_custkey % 2 = 0""")
def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderstatus"))
    attrs = fn.target_attributes("s3", fn.render("${bucket}", F.col("attrs")), prefix)
    return order_attributes(spark, sf_dir).select("o_orderkey", F.explode(attrs).alias("name", "value"))


@query("root_cause", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Outer' ELSE 'Inner' END AS class,
 CASE o_orderkey % 3 WHEN 0 THEN concat('outer ', o_orderkey) WHEN 1 THEN concat('inner ', o_orderkey) ELSE concat('outer ', o_orderkey) END AS message,
 'Outer' AS outer_class, concat('outer ', o_orderkey) AS outer_message FROM orders""")
def _root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_attributes(spark, sf_dir).select("o_orderkey", causes_column("o_orderkey").alias("causes"))
    deep, outer = fn.root_cause(F.col("causes")), fn.root_cause(F.col("causes"), deepest=False)
    return rows.select("o_orderkey", deep["class"].alias("class"), deep["message"].alias("message"),
                       outer["class"].alias("outer_class"), outer["message"].alias("outer_message"))


def causes_column(key: str) -> Column:
    n = F.col(key) % 3

    def cause(name: str, message: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), message.alias("message"))

    outer = cause("Outer", F.concat(F.lit("outer "), text(key)))
    inner = cause("Inner", F.when(n == 1, F.concat(F.lit("inner "), text(key))))
    return F.when(n == 0, F.array(outer)).otherwise(F.array(outer, inner))


@query("auth_mode", """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'both' WHEN c_custkey % 2 = 0 THEN 'password'
 WHEN c_custkey % 3 = 0 THEN 'key' ELSE 'none' END AS sftp, CASE WHEN c_custkey % 5 = 0 THEN 'password' ELSE 'anonymous' END AS share,
 CASE WHEN c_custkey % 5 = 0 AND c_custkey % 2 = 0 THEN 'password' ELSE 'anonymous' END AS put FROM customer""")
def _auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    password, key, user = k % 2 == 0, k % 3 == 0, k % 5 == 0
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.auth_mode("sftp", user, password, key).alias("sftp"),
        fn.auth_mode("share", user, password).alias("share"), fn.auth_mode("put", user, password).alias("put"))


@query("validate_triggers", """WITH x AS (SELECT s.*, s_suppkey % 2 = 0 AS e1, s_suppkey % 3 = 0 AS e2, s_suppkey % 5 = 0 AS e3, s_suppkey % 7 = 0 AS e4,
 s_suppkey % 11 = 0 AS e5, s_suppkey % 13 = 0 AS e6, s_suppkey % 4 = 0 AS e7, s_suppkey % 17 = 0 AS e8 FROM supplier s)
 SELECT s_suppkey, concat_ws('; ', CASE WHEN e1 THEN 'file_filter is not a valid pattern' END, CASE WHEN e2 THEN 'ignore_suffix holds a separator' END,
 CASE WHEN e3 THEN 'path_filter needs recursion' END, CASE WHEN e4 THEN 'password is missing' END,
 CASE WHEN e5 THEN 'initial_timestamp is malformed' END, CASE WHEN e6 THEN 'host is blank' END,
 CASE WHEN e7 THEN 'port is out of range' END, CASE WHEN e8 THEN 'batch_size is not positive' END) AS errors,
 NOT (e1 OR e2 OR e3 OR e4 OR e5 OR e6 OR e7 OR e8) AS is_valid FROM x""")
def _validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_suppkey")
    settings = table(spark, sf_dir, "supplier").select(
        n,
        F.when(n % 2 == 0, F.when(n % 6 == 0, "[").otherwise("a)(b")).when(n % 9 == 1, "${x}[").when(n % 9 == 3, " ")
         .otherwise("te.*").alias("file_filter"),
        F.when(n % 3 == 0, F.when(n % 2 == 0, "/x").otherwise("\\x")).when(n % 8 == 1, F.lit(".tmp")).alias("ignore_suffix"),
        F.when((n % 5 == 0) | (n % 8 == 1), "a.*").alias("path_filter"), (n % 5 != 0).alias("recursive"),
        (n % 7 == 0).alias("has_user"), (n % 7 != 0).alias("has_password"),
        F.when(n % 11 == 0, "2025-02-01").when(n % 8 == 1, "2025-02-01T00:00:00Z").when(n % 8 == 3, "1738368000000").alias("initial_timestamp"),
        F.when(n % 13 == 0, " \t").otherwise("h").alias("host"),
        F.when(n % 4 == 0, F.when(n % 8 == 0, "70000").otherwise("x")).otherwise("445").alias("port"),
        F.when(n % 17 == 0, 0).otherwise(100).alias("batch_size"))
    return validate_triggers(settings).select("s_suppkey", F.array_join("errors", "; ").alias("errors"), "is_valid")


@query("error_rows", f"""WITH x AS (SELECT *, o_orderkey % 3 AS k FROM ({_ORDER}) o)
 SELECT o_orderkey, 'failure' AS route, 'error.message' AS name, CASE WHEN k = 1 THEN concat('inner ', o_orderkey) ELSE concat('outer ', o_orderkey) END AS value FROM x
 UNION ALL SELECT o_orderkey, 'failure', 'error.class', CASE WHEN k = 0 THEN 'Outer' ELSE 'Inner' END FROM x
 UNION ALL SELECT o_orderkey, 'failure', 'smb.service.location', concat('smb://', CASE WHEN untriggered THEN '' ELSE bucket END, ':445/share') FROM x
 UNION ALL SELECT o_orderkey, 'failure', 'smb.listing.directory', CASE WHEN untriggered THEN '' ELSE o_orderstatus END FROM x
 UNION ALL SELECT o_orderkey, 'failure', 'bucket', bucket FROM x WHERE NOT untriggered
 UNION ALL SELECT o_orderkey, 'failure', 'status', o_orderstatus FROM x WHERE NOT untriggered
 UNION ALL SELECT o_orderkey, 'failure', 'prio', o_orderpriority FROM x WHERE NOT untriggered
 UNION ALL SELECT o_orderkey, 'failure', 'ff', ff FROM x WHERE NOT untriggered AND ff IS NOT NULL""")
def _error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("attrs")
    target = fn.target_attributes("smb", fn.service_uri(fn.render("${bucket}", a), F.lit(445), F.lit("share")), fn.render("${status}", a))
    rows = error_rows(order_attributes(spark, sf_dir), causes_column("o_orderkey"), target, deepest=True)
    return rows.select("o_orderkey", "route", F.explode("attributes").alias("name", "value"))
