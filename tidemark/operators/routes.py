"""Routing of fetches, deletes and messages: one route per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.envelope import ack, classify_message, json_fields, message_state
from tidemark.functions.values import classify_error, error_code_text
from tidemark.operators.predicates import message_size, topic_filter
from tidemark.schema import FAILURE, SUCCESS, TEXT_LIMIT


def route_fetch(fetched: DataFrame, error_code: str = "code", error_message: str = "message") -> DataFrame:
    """Fetched rows: success, or failure with code and message."""
    failed = F.col(error_code).isNotNull() | F.col(error_message).isNotNull()
    return fetched.withColumns({
        "route": F.when(failed, FAILURE).otherwise(SUCCESS),
        "error_code": F.when(failed, error_code_text(F.col(error_code))),
        "error_message": F.when(failed, F.col(error_message)),
    })


def route_delete(outcomes: DataFrame, deleted: Column, error_code: str = "code",
                 error_message: str = "message") -> DataFrame:
    """Deletes: success, ``not found`` (no error attributes) or failure (with them)."""
    route = F.when(deleted, F.lit(SUCCESS)).otherwise(classify_error(F.col(error_code)))
    out = outcomes.withColumn("route", route)
    failed = F.col("route") == FAILURE
    return out.withColumns({
        "error_code": F.when(failed, error_code_text(F.col(error_code))),
        "error_message": F.when(failed, F.col(error_message)),
    })


def route_message(messages: DataFrame, limit: int = TEXT_LIMIT, with_error: bool = False,
                  topics: Column | str | None = None) -> DataFrame:
    """Add ``route`` and ``ack`` to messages; every row keeps its body.

    Messages over the size limit fail without being parsed.  ``with_error``
    adds ``error_message`` on failures (banking listener).  ``topics`` drops
    messages that are known to be of another topic; those whose event cannot be
    told (too large, malformed, without an event) stay.  Stateless and in one pass, so it
    serves batches and streams alike.
    """
    small = F.coalesce(message_size(limit), F.lit(True))
    out = messages.withColumn("_json", F.when(small, json_fields(F.col("body"))))
    out = out.withColumn("_m", message_state(F.col("body"), F.col("_json")))
    route = F.when(small, classify_message(F.col("_m.state"))).otherwise(F.lit(FAILURE))
    extra = {"route": route, "ack": F.when(small, ack(F.col("_m")))}
    if with_error:
        reason = F.when(~small, "message too large").when(F.col("_m.state") == "missing", "id or event is missing")
        extra["error_message"] = reason
    out = out.withColumns(extra)
    if topics is not None:
        out = out.where(F.coalesce(topic_filter(topics, "_m.event"), F.lit(True)))
    return out.drop("_json", "_m")
