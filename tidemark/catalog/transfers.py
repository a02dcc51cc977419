"""Queries over fetches, writes and deletes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.catalog.functions import error_code
from tidemark.catalog.registry import query
from tidemark.catalog.views import ORDER_KEYS, inventory, line_inventory, table, text, write_requests
from tidemark.operators import transfer
from tidemark.operators.effects import delete_files, fetch_commit_complete, lost_batches, publish
from tidemark.operators.routes import route_delete, route_fetch
from tidemark.plans.storage import open_store, shared_dir, stage
from tidemark.sources.content import attach_content, fetch_content
from tidemark.sources.datasource import register
from tidemark.sources.inventory import scan_inventory

_FROM = "1998-01-01"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

_PLAN = f"""WITH w AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY {_ORDER}) AS rn,
  row_number() OVER (PARTITION BY host, dest ORDER BY {_ORDER}) AS dn FROM req WHERE last_modified >= TIMESTAMP '{_FROM}'),
 e AS (SELECT DISTINCT host, dest, true AS ex0 FROM req WHERE last_modified < TIMESTAMP '{_FROM}'),
 a AS (SELECT w.*, coalesce(ex0, false) OR dn > 1 AS ex, CAST(ceil(rn / 100) AS BIGINT) AS batch_no FROM w LEFT JOIN e USING (host, dest)),
 p AS (SELECT *, CASE WHEN NOT ex THEN 'create' WHEN conflict = 'replace' THEN 'overwrite' WHEN conflict = 'ignore' THEN 'skip' ELSE 'reject' END AS write_action FROM a)"""


def _by_keys() -> list[Column]:
    """The order of requests: that of their keys, those without one last."""
    return [F.col(c).asc_nulls_last() for c in ORDER_KEYS]


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows, since = write_requests(spark, sf_dir), F.lit(_FROM).cast("timestamp")
    new = rows.where(F.col("last_modified") >= since)
    return new, rows.where(F.col("last_modified") < since).select("host", "share", "dest")


@query("assign_batches", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, host, CAST(ceil(row_number() OVER (PARTITION BY host ORDER BY {_ORDER}) / 100) AS BIGINT) AS batch_no FROM req", ("invl", "req"))
def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.assign_batches(write_requests(spark, sf_dir), order=_by_keys()).select(*_KEYS, "host", "batch_no")


@query("next_batch", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, host FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY {_ORDER}) AS rn FROM req) x WHERE rn <= 100", ("invl", "req"))
def _next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.next_batch(write_requests(spark, sf_dir), order=_by_keys()).select(*_KEYS, "host")


@query("resolve_conflicts", f"{_PLAN} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, host, dest, ex AS target_exists FROM a", ("invl", "req"))
def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, existing = _requests(spark, sf_dir)
    return transfer.resolve_conflicts(new, existing, seq="place").select(*_KEYS, "host", "dest", "target_exists")


@query("plan_writes", f"""{_PLAN} SELECT host, write_action, count(*) AS n, max(batch_no) AS batches FROM p GROUP BY 1, 2""", ("invl", "req"))
def _plan_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, existing = _requests(spark, sf_dir)
    plan = transfer.plan_writes(new, existing, create_dirs=True, order=_by_keys(), seq="place")
    return plan.groupBy("host", "write_action").agg(F.count(F.lit(1)).alias("n"), F.max("batch_no").alias("batches"))


@query("plan_writes_missing_directories", f"""{_PLAN}, d AS (SELECT DISTINCT host, directory FROM req WHERE last_modified < TIMESTAMP '1992-06-01')
 SELECT host, CASE WHEN d.directory IS NULL THEN 'missing_directory' ELSE write_action END AS write_action, count(*) AS n
 FROM p LEFT JOIN d USING (host, directory) GROUP BY 1, 2""", ("invl", "req"))
def _plan_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, existing = _requests(spark, sf_dir)
    old = write_requests(spark, sf_dir).where(F.col("last_modified") < F.lit("1992-06-01").cast("timestamp"))
    plan = transfer.plan_writes(new, existing, old.select("host", "share", "dest_dir"), batch_size=None, seq="place")
    return plan.groupBy("host", "write_action").agg(F.count(F.lit(1)).alias("n"))


@query("route_write", f"""{_PLAN} SELECT host, route, count(*) AS n FROM (SELECT host, CASE WHEN write_action = 'reject' OR l_partkey % 50 = 0
 OR (host = 'c3' AND batch_no = 2) THEN 'failure' ELSE 'success' END AS route FROM p) x GROUP BY 1, 2""", ("invl", "req"))
def _route_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some single writes failed, and host c3 lost the connection of its second batch."""
    new, existing = _requests(spark, sf_dir)
    plan = transfer.plan_writes(new, existing, create_dirs=True, order=_by_keys(), seq="place")
    lost = plan.where((F.col("host") == "c3") & (F.col("batch_no") == 2)).select("host", "share", "batch_no")
    routed = transfer.route_write(plan, new.where(F.col("l_partkey") % 50 == 0).select("seq"), lost)
    return routed.groupBy("host", "route").agg(F.count(F.lit(1)).alias("n"))


@query("plan_directories", """WITH d AS (SELECT DISTINCT host, directory FROM req),
 f AS (SELECT host, 'data' AS dest_dir, 1 AS depth FROM d UNION SELECT host, concat('data/', split_part(directory, '/', 2)), 2 FROM d
  UNION SELECT host, directory, 3 FROM d)
 SELECT host, dest_dir, depth FROM f WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.host = f.host AND d.directory = f.dest_dir AND ends_with(d.directory, '/O'))""", ("invl", "req"))
def _directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = write_requests(spark, sf_dir)
    there = requests.where(F.col("dest_dir").endswith("/O")).select("host", "share", "dest_dir")
    return transfer.plan_directories(requests, there).select("host", "dest_dir", "depth")


@query("effective_writes", f"""{_PLAN} SELECT host, dest, max(seq) AS seq FROM p WHERE write_action IN ('create', 'overwrite') GROUP BY 1, 2""", ("invl", "req"))
def _effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, existing = _requests(spark, sf_dir)
    plan = transfer.plan_writes(new, existing, create_dirs=True, batch_size=None, seq="place")
    return transfer.effective_writes(plan).where("is_effective").select("host", "dest", "seq")


def _content(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    listing = inventory(spark, sf_dir)
    names = listing.where(~F.col("is_directory") & ~F.col("filename").endswith(".tmp")).select("doc_id", "full_path")
    body = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    stored = names.join(body, "doc_id").select(F.concat(F.lit("/"), F.replace("full_path", F.lit("/"), F.lit("\\"))).alias("path"), "content")
    return listing, stored


@query("attach_content", """SELECT inv.doc_id, CASE WHEN is_directory OR ends_with(filename, '.tmp') THEN 'failure' ELSE 'success' END AS route,
 CASE WHEN NOT is_directory AND NOT ends_with(filename, '.tmp') THEN md5(text) END AS digest,
 CASE WHEN is_directory OR ends_with(filename, '.tmp') THEN '3221225524' END AS error_code FROM inv JOIN documents USING (doc_id)""", ("inv",))
def _attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing, stored = _content(spark, sf_dir)
    rows = attach_content(listing, stored)
    return rows.select("doc_id", "route", F.md5("content").alias("digest"), "error_code")


@query("route_fetch", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN 'failure' ELSE 'success' END AS route,
 CASE WHEN l_partkey % 3 = 0 THEN CASE l_partkey % 5 WHEN 0 THEN '3221225487' WHEN 1 THEN '3221225524' WHEN 2 THEN '3221225530' WHEN 3 THEN '3221225506' ELSE '-2' END END AS error_code,
 CASE WHEN l_partkey % 3 = 0 THEN concat('cannot read ', filename) END AS error_message FROM invl""", ("invl",))
def _route_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("l_partkey") % 3 == 0
    rows = line_inventory(spark, sf_dir).withColumn("code", F.when(bad, error_code())) \
        .withColumn("message", F.when(bad, F.concat(F.lit("cannot read "), "filename")))
    return route_fetch(rows).select(*_KEYS, "route", "error_code", "error_message")


@query("route_delete", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 2 = 0 THEN 'success' WHEN l_partkey % 5 < 3 THEN 'not found' ELSE 'failure' END AS route,
 CASE WHEN l_suppkey % 2 <> 0 AND l_partkey % 5 = 3 THEN '3221225506' WHEN l_suppkey % 2 <> 0 AND l_partkey % 5 = 4 THEN '-2' END AS error_code,
 CASE WHEN l_suppkey % 2 <> 0 AND l_partkey % 5 >= 3 THEN 'refused' END AS error_message FROM lineitem""")
def _route_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_inventory(spark, sf_dir).withColumn("code", error_code()).withColumn("message", F.lit("refused"))
    return route_delete(rows, F.col("l_suppkey") % 2 == 0).select(*_KEYS, "route", "error_code", "error_message")


@query("plan_completion", """SELECT doc_id, 'move' AS strategy, CASE WHEN is_directory THEN 'none' ELSE 'move' END AS completion,
 CASE WHEN NOT is_directory THEN concat('done/', container, '/', filename) END AS move_to,
 CASE WHEN NOT is_directory THEN concat('done/', container) END AS ensure_directory FROM inv
 UNION ALL SELECT doc_id, 'delete', CASE WHEN is_directory THEN 'none' ELSE 'delete' END, NULL, NULL FROM inv
 UNION ALL SELECT doc_id, 'none', 'none', NULL, NULL FROM inv""", ("inv",))
def _completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = inventory(spark, sf_dir).withColumn("route", F.when(F.col("is_directory"), "failure").otherwise("success"))
    plans = [transfer.plan_completion(fetched, "move", F.concat(F.lit("done/"), "container"), create_directory=True),
             transfer.plan_completion(fetched, "delete"), transfer.plan_completion(fetched, "none")]
    rows = [p.select("doc_id", F.lit(s).alias("strategy"), "completion", "move_to", "ensure_directory")
            for p, s in zip(plans, ("move", "delete", "none"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _publish_all(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Every document as a write request to one of three hosts, which share names; two share a target, a tenth have no content."""
    docs = table(spark, sf_dir, "documents")
    requests = docs.select(F.col("doc_id").alias("seq"), F.concat(F.lit("h"), text(F.col("doc_id") % 3)).alias("host"),
                           F.lit("share").alias("share"), F.col("lang").alias("directory"),
                           F.concat(F.lit("d"), text(F.floor(F.col("doc_id") / 6)), F.lit(".txt")).alias("filename"),
                           F.lit("replace").alias("conflict"))
    nothing = transfer.with_destination(requests).select("host", "share", "dest").where(F.lit(False))
    plan = transfer.plan_writes(requests, nothing, create_dirs=True, batch_size=None)
    content = docs.where(F.col("doc_id") % 10 != 9).select(F.col("doc_id").alias("seq"), F.col("text").cast("binary").alias("content"))
    return publish(plan, content, root, tmp_suffix=".part").withColumn("path", F.concat_ws("/", "host", "share", "dest"))


_PATH = "concat('h', doc_id % 3, '/share/', lang, '/d', CAST(floor(doc_id / 6) AS BIGINT), '.txt')"
_LAST = f"last AS (SELECT {_PATH} AS path, max(doc_id) AS doc_id FROM documents WHERE doc_id % 10 <> 9 GROUP BY 1)"


def _written(published: DataFrame) -> DataFrame:
    """The files that are there now, each with its last successful request."""
    return published.where("done").groupBy("path").agg(F.max("seq").alias("seq"))


@query("publish", f"""WITH {_LAST} SELECT d.doc_id, p.path, d.doc_id % 10 <> 9 AS done, md5(l.text) AS digest
 FROM documents d JOIN (SELECT doc_id, {_PATH} AS path FROM documents) p USING (doc_id) LEFT JOIN last ON last.path = p.path
 LEFT JOIN documents l ON l.doc_id = last.doc_id""")
def _publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of every request, and the bytes found at its target: the last write that had content is there."""
    root = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    outcome = _publish_all(spark, sf_dir, root).select(F.col("seq").alias("doc_id"), F.col("path").alias("full_path"), "done")
    rows = fetch_content(outcome, root, partitions=8)
    return rows.select("doc_id", F.col("full_path").alias("path"), "done", F.md5("content").alias("digest"))


@query("publish_lost_target", """SELECT doc_id % 3 AS host, ceil(row_number() OVER (PARTITION BY doc_id % 3 ORDER BY doc_id) / 100) :: BIGINT AS batch_no,
 CASE WHEN doc_id % 3 = 1 THEN 'failure' ELSE 'success' END AS route, doc_id FROM documents""")
def _publish_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is written to one of three hosts in batches; one host's root is no folder, and its batches fail as a whole."""
    root = f"{shared_dir(spark)}/lost-{uuid.uuid4().hex}"
    store, folder = open_store(root)
    store.create_dir(f"{folder}/h1", recursive=True)
    with store.open_output_stream(f"{folder}/h1/share") as broken:
        broken.write(b"no folder")
    docs = table(spark, sf_dir, "documents")
    requests = docs.select(F.col("doc_id").alias("seq"), F.concat(F.lit("h"), text(F.col("doc_id") % 3)).alias("host"), F.lit("share").alias("share"),
                           F.col("lang").alias("directory"), text("doc_id").alias("filename"), F.lit("replace").alias("conflict"))
    nothing = transfer.with_destination(requests).select("host", "share", "dest").where(F.lit(False))
    plan = transfer.plan_writes(requests, nothing, create_dirs=True)
    out = publish(plan, docs.select(F.col("doc_id").alias("seq"), F.col("text").cast("binary").alias("content")), root)
    routed = transfer.route_write(out, out.where("NOT done").select("seq"), lost_batches(out))
    return routed.select(F.substring("host", 2, 1).cast("bigint").alias("host"), "batch_no", "route", F.col("seq").alias("doc_id"))


@query("fetch_content", f"""WITH {_LAST} SELECT doc_id, path, trigger_id, CASE WHEN trigger_id < 2 THEN 'success' ELSE 'failure' END AS route,
 CASE WHEN trigger_id < 2 THEN md5(text) END AS digest, CASE WHEN trigger_id = 2 THEN '3221225524' END AS error_code
 FROM last JOIN documents USING (doc_id) CROSS JOIN (VALUES (0), (1), (2)) t(trigger_id)""")
def _fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triggers list each published file, a third one a file that is gone; trigger columns stay on the fetched rows."""
    root = f"{shared_dir(spark)}/fetched-{uuid.uuid4().hex}"
    listed = _written(_publish_all(spark, sf_dir, root)).withColumn("trigger_id", F.explode(F.array(*map(F.lit, range(3)))))
    listed = listed.withColumn("full_path", F.when(F.col("trigger_id") == 2, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")))
    return fetch_content(listed, root).select(F.col("seq").alias("doc_id"), "path", "trigger_id", "route", F.md5("content").alias("digest"), "error_code")


@query("delete_files", f"""WITH {_LAST}, r AS (SELECT path, 'success' AS route FROM last UNION ALL SELECT path, 'not found' FROM last
 UNION ALL SELECT concat('nowhere/', path), 'not found' FROM last) SELECT route, count(*) AS n FROM r GROUP BY route""")
def _delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published file is deleted twice, and one that is not there is asked for."""
    root = f"{shared_dir(spark)}/deleted-{uuid.uuid4().hex}"
    paths = _written(_publish_all(spark, sf_dir, f"{root}/files"))
    wanted = F.array(F.struct((F.col("seq") * 3).alias("seq"), F.col("path")),
                     F.struct((F.col("seq") * 3 + 1).alias("seq"), F.col("path")),
                     F.struct((F.col("seq") * 3 + 2).alias("seq"), F.concat(F.lit("nowhere/"), "path").alias("path")))
    done = delete_files(paths.select(F.inline(wanted)), f"{root}/files", f"{root}/markers")
    return route_delete(done, F.col("done")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("complete", f"WITH {_LAST} SELECT concat('done/', path) AS path, 'success' AS route, md5(text) AS digest, true AS stored FROM last JOIN documents USING (doc_id)")
def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are fetched, their content is stored and read back, and only then they are moved; the moved files are read again."""
    root = f"{shared_dir(spark)}/completed-{uuid.uuid4().hex}"
    listed = _written(_publish_all(spark, sf_dir, f"{root}/files")).select(
        "seq", F.col("path").alias("full_path"), F.substring_index("path", "/", -1).alias("filename"))
    folder = F.concat(F.lit("done/"), F.regexp_replace("full_path", "/[^/]*$", ""))
    stored, outcome = fetch_commit_complete(listed, f"{root}/files", lambda fetched: stage(fetched, "fetched"), "move", folder, True)
    there = stored.where("route = 'success'").join(outcome.where("done").select("seq"), "seq").select(
        F.concat(folder, F.lit("/"), "filename").alias("full_path"), F.md5("content").alias("_digest"))
    moved = fetch_content(there, f"{root}/files")
    return moved.select(F.col("full_path").alias("path"), "route", F.md5("content").alias("digest"),
                        (F.md5("content") == F.col("_digest")).alias("stored"))


@query("folder_source", f"""WITH {_LAST} SELECT split_part(path, '/', 3) AS lang, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes
 FROM last JOIN documents USING (doc_id) WHERE starts_with(path, 'h1/share/') GROUP BY 1""")
def _folder_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are published as files, and one host's are listed through the lazy source, which opens only its folders."""
    root = f"{shared_dir(spark)}/source-{uuid.uuid4().hex}"
    _publish_all(spark, sf_dir, root)
    files = spark.read.format(register(spark)).load(root).where(F.startswith("full_path", F.lit("h1/share/")))
    return files.groupBy(F.split_part("full_path", F.lit("/"), F.lit(3)).alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


@query("committed_write", """SELECT l_orderkey, l_linenumber, CAST(l_quantity * 1000 AS BIGINT) AS size FROM lineitem""")
def _committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing written through the source: its files appear when the job commits."""
    path = f"{shared_dir(spark)}/committed-{uuid.uuid4().hex}"
    line_inventory(spark, sf_dir).select("l_orderkey", "l_linenumber", "size").write.format(register(spark)).mode("append").save(path)
    return spark.read.parquet(path)


@query("scan_inventory", f"""WITH {_LAST} SELECT path AS full_path, strlen(text) AS size, false AS is_directory FROM last JOIN documents USING (doc_id)
 UNION ALL SELECT DISTINCT split_part(path, '/', 1), 0, true FROM last UNION ALL SELECT DISTINCT concat(split_part(path, '/', 1), '/share'), 0, true FROM last
 UNION ALL SELECT DISTINCT regexp_replace(path, '/[^/]*$', ''), 0, true FROM last""")
def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are published as files, then their folders are listed."""
    root = f"{shared_dir(spark)}/scanned-{uuid.uuid4().hex}"
    _publish_all(spark, sf_dir, root)
    return scan_inventory(spark, root, with_directories=True).select("full_path", "size", "is_directory")
