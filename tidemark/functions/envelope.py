"""Event messages: one strict JSON parse decides route and acknowledgement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.schema import ENVELOPE, FAILURE, TEXT_MESSAGE

_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_bad",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def json_fields(body: Column) -> Column:
    """Strict parse of a body: ``id`` and ``event`` as variants, ``_bad`` set if it is no JSON object.

    As variants an absent field is null while a JSON null is a variant null, a
    repeated field keeps its last value, and the node kind stays known.
    """
    return F.from_json(body, "id variant, event variant, _bad string", _STRICT)


def message_state(body: Column, fields: Column | None = None) -> Column:
    """Struct ``(state, id, event)`` for a message body.

    ``state`` is ``ok`` (an object with both fields), ``missing`` (valid JSON
    or blank text without them) or ``bad`` (not JSON).  ``fields`` is a column
    that already holds ``json_fields(body)``; pass it so that the text is parsed
    once.  The further parses are reached only by rows whose first one failed.
    """
    j = json_fields(body) if fields is None else fields
    valid_other = F.try_parse_json(body).isNotNull() | F.from_json(body, "array<string>", _STRICT).isNotNull()
    state = (F.when(body.isNull(), "missing")
             .when(j["_bad"].isNotNull(), F.when(valid_other, "missing").otherwise("bad"))
             .when(j["id"].isNull() | j["event"].isNull(), "missing")
             .otherwise("ok"))
    return F.struct(state.alias("state"), _node_text(j["id"]).alias("id"), _node_text(j["event"]).alias("event"))


def _node_text(v: Column) -> Column:
    """Text of a JSON node: ``null`` for null, empty for a container.

    The node kind is looked up only for text that may come from a container or
    a number.
    """
    text, kind = F.try_variant_get(v, "$", "string"), F.schema_of_variant(v)
    is_fraction = kind.startswith("DECIMAL") & ~kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    first = F.substring(text, 1, 1)
    return (F.when(F.is_variant_null(v), F.lit("null"))
            .when(first.isin("{", "[") & kind.rlike("^(OBJECT|ARRAY)"), F.lit(""))
            .when(first.isin(*"-0123456789") & is_fraction, F.try_variant_get(v, "$", "double").cast("string"))
            .otherwise(text))


def classify_message(state: Column) -> Column:
    """Route of a message, given the ``state`` field of ``message_state``."""
    return F.when(state == "missing", F.lit(FAILURE)).otherwise(F.lit(TEXT_MESSAGE))


def ack(message: Column) -> Column:
    """Acknowledgement for a ``message_state`` struct, null when none is due."""
    due = (message["state"] == "ok") & ~message["event"].startswith("/")
    return F.when(due, F.to_json(F.struct(F.lit("ack").alias("event"), message["id"].alias("msg"))))


def remote_attributes(remote_address: Column) -> Column:
    return F.create_map(F.lit("websocket.remote.address"), remote_address)


def parse_envelope(body: Column) -> Column:
    """The event envelope as a struct; null fields where the body has none."""
    return F.from_json(body, ENVELOPE, {"mode": "PERMISSIVE"})


def object_id(envelope: Column) -> Column:
    """The JSON held in the ``objectId`` string, as a map."""
    return F.from_json(envelope["msg"]["objectId"], "map<string,string>", {"mode": "PERMISSIVE"})
