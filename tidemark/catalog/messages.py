"""Queries over event messages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.views import messages, table, text
from tidemark.functions import object_id, parse_envelope
from tidemark.operators.routes import route_message
from tidemark.plans.storage import shared_dir
from tidemark.schema import MESSAGES, TEXT_LIMIT
from tidemark.streaming import dedupe_messages, run_message_routes

_ROUTED = """WITH x AS (SELECT message_id, body, event_type, CASE WHEN trim(body) = '' THEN 'blank' WHEN NOT json_valid(body) THEN 'bad'
  WHEN json_type(body) <> 'OBJECT' THEN 'nonobj'
  WHEN list_contains(json_keys(body), 'id') AND list_contains(json_keys(body), 'event') THEN 'ok' ELSE 'missing' END AS st FROM msg),
 r AS (SELECT message_id, body, event_type, st, CASE WHEN st IN ('bad', 'ok') THEN 'text message' ELSE 'failure' END AS route,
 CASE WHEN st = 'ok' AND NOT starts_with(coalesce(body->>'$.event', 'null'), '/')
  THEN concat('{"event":"ack","msg":"', coalesce(body->>'$.id', 'null'), '"}') END AS ack FROM x)"""


@query("route_message", f"{_ROUTED} SELECT message_id, route, ack FROM r", ("msg",))
def _route_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_message(messages(spark, sf_dir)).select("message_id", "route", "ack")


@query("ack", f"{_ROUTED} SELECT message_id, ack FROM r WHERE ack IS NOT NULL", ("msg",))
def _ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_message(messages(spark, sf_dir)).where("ack IS NOT NULL").select("message_id", "ack")


@query("route_message_banking", f"""{_ROUTED} SELECT message_id, body, CASE WHEN strlen(body) > 40 THEN 'failure' ELSE route END AS route,
 CASE WHEN strlen(body) <= 40 THEN ack END AS ack, CASE WHEN strlen(body) > 40 THEN 'message too large'
 WHEN st IN ('missing', 'nonobj', 'blank') THEN 'id or event is missing' END AS error_message FROM r""", ("msg",))
def _banking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small limit, so that the size rule takes part."""
    rows = route_message(messages(spark, sf_dir), limit=40, with_error=True)
    return rows.select("message_id", "body", "route", "ack", "error_message")


@query("route_message_topics", f"""{_ROUTED} SELECT message_id, route, ack FROM r
 WHERE coalesce(CASE WHEN st IN ('ok', 'missing') THEN body->>'$.event' END IN ('click', 'view'), true)""", ("msg",))
def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_message(messages(spark, sf_dir), topics="click,view").select("message_id", "route", "ack")


@query("parse_envelope", """SELECT event_id, CAST(event_id AS VARCHAR) AS id, concat('model.v1.', event_type) AS event,
 concat('user', user_id) AS user_id, event_id AS version, concat('k', user_id) AS data_id,
 strftime(ts, '%Y-%m-%dT%H:%M:%S.474301733Z') AS event_dtm, 'folder' AS object_table FROM events""")
def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(
        text("event_id").alias("id"), F.concat(F.lit("model.v1."), "event_type").alias("event"),
        F.struct(F.concat(F.lit("user"), text("user_id")).alias("user_id"), F.lit("c").alias("connection_id")).alias("client"),
        F.struct(F.col("event_id").alias("version"),
                 F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'.474301733Z'").alias("eventDtm"),
                 F.struct(F.concat(F.lit("k"), text("user_id")).alias("_Id"), F.lit(0).alias("_vn")).alias("data"),
                 F.lit('{"_uLog":"u","table":"folder"}').alias("objectId")).alias("msg")))
    parsed = e.select("event_id", body.alias("body")).withColumn("e", parse_envelope(F.col("body")))
    return parsed.select(
        "event_id", F.col("e.id").alias("id"), F.col("e.event").alias("event"), F.col("e.client.user_id").alias("user_id"),
        F.col("e.msg.version").alias("version"), F.col("e.msg.data")["_Id"].alias("data_id"),
        F.col("e.msg.eventDtm").alias("event_dtm"), object_id(F.col("e"))["table"].alias("object_table"))


def _landed(spark: SparkSession, rows: DataFrame, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    rows.select(*MESSAGES.fieldNames()).write.json(f"{path}/in")
    return path


@query("route_messages_stream", f"""{_ROUTED} SELECT message_id, route, ack FROM r""", ("msg",))
def _route_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a stream: stored by route, acknowledgements as a second output."""
    path = _landed(spark, messages(spark, sf_dir), "messages")
    stream = spark.readStream.schema(MESSAGES).json(f"{path}/in")
    run_message_routes(stream, f"{path}/out", f"{path}/acks", f"{path}/checkpoint", TEXT_LIMIT).awaitTermination()
    stored = spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out").select("message_id", "route")
    acks = spark.read.parquet(f"{path}/acks").select("message_id", "ack")
    return stored.join(acks, "message_id", "left").select("message_id", "route", "ack")


@query("dedupe_messages", "SELECT message_id, body FROM msg", ("msg",))
def _dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message arrives twice and is stored once."""
    rows = messages(spark, sf_dir)
    path = _landed(spark, rows.unionByName(rows), "replays")
    stream = dedupe_messages(spark.readStream.schema(MESSAGES).json(f"{path}/in"), delay="3650 days")
    (stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(f"{path}/out").select("message_id", "body")
