"""Sources and sinks."""

from tidemark.sources.content import attach_content, fetch_content
from tidemark.sources.inventory import any_object, read_manifest, scan_inventory, scope, union_providers
from tidemark.sources.messages import message_stream, read_messages, read_triggers, trigger_stream
from tidemark.sources.sinks import read_listing_ids, write_empty, write_listing

__all__ = ["any_object", "attach_content", "fetch_content", "message_stream", "read_listing_ids",
           "read_manifest", "read_messages", "read_triggers", "scan_inventory", "scope",
           "trigger_stream", "union_providers", "write_empty", "write_listing"]
