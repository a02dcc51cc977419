"""Column functions: every one takes and returns plain Spark Columns."""

from tidemark.functions.envelope import (
    ack, classify_message, json_fields, message_state, object_id, parse_envelope, remote_attributes,
)
from tidemark.functions.paths import (
    ancestors, depth, display_path, join_path, normalise_path, parent, relative_dir,
    service_uri, transit_uri,
)
from tidemark.functions.templates import (
    blank_as_null, full_match, has_placeholder, pattern_compiles, render, render_column,
    resolve_filter, wrap_full,
)
from tidemark.functions.values import (
    auth_mode, classify_error, error_attributes, error_code_text, iso_seconds, merge_attributes,
    parse_duration, parse_initial_timestamp, parse_size, root_cause, target_attributes,
    to_attributes,
)

__all__ = [
    "ack", "ancestors", "auth_mode", "blank_as_null", "classify_error", "classify_message",
    "depth", "display_path", "error_attributes", "error_code_text", "full_match",
    "has_placeholder", "iso_seconds", "join_path", "json_fields", "merge_attributes", "message_state",
    "normalise_path", "object_id", "parent", "parse_duration", "parse_envelope",
    "parse_initial_timestamp", "parse_size", "pattern_compiles", "relative_dir",
    "remote_attributes", "render", "render_column", "resolve_filter", "root_cause",
    "service_uri", "target_attributes", "to_attributes", "transit_uri", "wrap_full",
]
