"""Table shapes shared by every operator.

The inventory is the one row-per-file table that the four storage providers
are mapped onto; everything a single provider knows on top of that lives in
``extra`` so that the union of providers has one schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

ATTRS = T.MapType(T.StringType(), T.StringType())

INVENTORY = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("container", T.StringType()),
    T.StructField("directory", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("full_path", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("is_directory", T.BooleanType()),
    T.StructField("etag", T.StringType()),
    T.StructField("extra", ATTRS),
])

TRIGGERS = T.StructType([
    T.StructField("trigger_id", T.LongType()),
    T.StructField("attrs", ATTRS),
])

MESSAGES = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("remote_address", T.StringType()),
    T.StructField("body", T.StringType()),
])

REQUESTS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("host", T.StringType()),
    T.StructField("share", T.StringType()),
    T.StructField("directory", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("conflict", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

# Event envelope.  ``objectId`` is JSON carried inside a string.
ENVELOPE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("client", T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("connection_id", T.StringType()),
    ])),
    T.StructField("msg", T.StructType([
        T.StructField("correlationID", T.StringType()),
        T.StructField("eventKey", T.StringType()),
        T.StructField("eventDtm", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("resourceURI", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("data", ATTRS),
        T.StructField("journal", ATTRS),
        T.StructField("objectId", T.StringType()),
    ])),
])

# Route names.
SUCCESS = "success"
FAILURE = "failure"
NO_FILES = "no_files"
NOT_FOUND = "not found"
TEXT_MESSAGE = "text message"

# Text message limits in bytes, plain and banking listener.
TEXT_LIMIT = 1_048_576
BANKING_TEXT_LIMIT = 1_073_741_824

# Defaults of the listing and writing components.
DEFAULT_MIN_AGE = "5 secs"
DEFAULT_BATCH_SIZE = 100
DEFAULT_SCHEDULE = "1 minute"
