"""Registry of queries, and the SQL views their oracles start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query and, if given, its oracle on top of the named SQL views."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Table times carry no zone; instants are compared in UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            head = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in views)
            body = sql.strip()
            if head and body.upper().startswith("WITH "):
                body = "WITH " + head + ", " + body[5:]
            elif head:
                body = "WITH " + head + " " + body
            ORACLES[name] = body
        return run

    return register


# The instant all ages are measured at, and the time of the first file.
BASE_MS = 1_704_067_200_000
NOW_MS = BASE_MS + 60_000_000

SQL_VIEWS = {
    "inv": f"""
SELECT source AS container, concat('data/', lang, '/b', CAST(doc_id % 7 AS VARCHAR)) AS directory,
 concat(CASE WHEN doc_id % 31 = 0 THEN '.' ELSE '' END, 'doc_', CAST(doc_id AS VARCHAR),
   CASE doc_id % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.txt' WHEN 2 THEN '.json' WHEN 3 THEN '.tmp' ELSE '.done' END) AS filename,
 concat('data/', lang, '/b', CAST(doc_id % 7 AS VARCHAR), '/', CASE WHEN doc_id % 31 = 0 THEN '.' ELSE '' END, 'doc_',
   CAST(doc_id AS VARCHAR),
   CASE doc_id % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.txt' WHEN 2 THEN '.json' WHEN 3 THEN '.tmp' ELSE '.done' END) AS full_path,
 n_chars AS size, {BASE_MS} + (doc_id * 60000) % 60000000 AS last_modified_ms,
 doc_id % 97 = 0 AS is_directory, md5(text) AS etag, doc_id
FROM documents""",
    "invl": """
SELECT concat('c', CAST(l_suppkey % 20 AS VARCHAR)) AS container, concat('data/', l_returnflag, '/', l_linestatus) AS directory,
 concat('f', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR),
   CASE l_partkey % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.txt' WHEN 2 THEN '.json' ELSE '.tmp' END) AS filename,
 CAST(l_quantity * 1000 AS BIGINT) AS size, l_shipdate AS last_modified, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
 concat_ws('/', concat('data/', l_returnflag, '/', l_linestatus), concat('f', l_orderkey, '_', l_linenumber), l_partkey, l_suppkey) AS k
FROM lineitem""",
    "msg": """
SELECT event_id AS message_id, event_type, CASE event_id % 10 WHEN 0 THEN '{bad'
 WHEN 1 THEN concat('{"event":"', event_type, '"}')
 WHEN 2 THEN concat('{"id":"', CAST(event_id AS VARCHAR), '"}')
 WHEN 3 THEN concat('{"id":"', CAST(event_id AS VARCHAR), '","event":"/sys/', event_type, '"}')
 WHEN 4 THEN '[1]' WHEN 5 THEN concat('{"id":null,"event":"', event_type, '"}') WHEN 6 THEN ''
 ELSE concat('{"id":"', CAST(event_id AS VARCHAR), '","event":"', event_type, '","msg":', props, '}') END AS body
FROM events""",
    "nat": """
SELECT n_nationkey AS trigger_id, concat('c', n_nationkey) AS container, n_name,
 nullif(trim(CASE n_nationkey % 4 WHEN 0 THEN '.*[.]csv' WHEN 1 THEN '' WHEN 2 THEN '   ' ELSE 'nomatch' END), '') AS ff
FROM nation""",
    "sup": """
SELECT s_suppkey AS trigger_id, concat('src', CAST(s_suppkey % 24 AS VARCHAR)) AS container,
 concat('data/', CASE s_suppkey % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'fr/b1' WHEN 2 THEN 'de/b' WHEN 3 THEN 'xx' ELSE '' END) AS prefix,
 nullif(trim(CASE s_suppkey % 3 WHEN 0 THEN '.*[.]csv' WHEN 1 THEN ' ' ELSE 'doc_[0-9]*1.*' END), '') AS ff
FROM supplier""",
    "req": """
SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS seq,
 container AS host, 'share' AS share, directory, filename, concat_ws('/', directory, filename) AS dest, last_modified,
 CASE l_suppkey % 3 WHEN 0 THEN 'replace' WHEN 1 THEN 'ignore' ELSE 'fail' END AS conflict,
 l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM invl""",
}
