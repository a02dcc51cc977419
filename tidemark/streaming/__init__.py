"""Structured Streaming forms of the listing and message operators."""

from tidemark.streaming.entity_stream import track_entities_stream
from tidemark.streaming.listing_stream import (
    EntityListing, TimestampListing, TriggeredListing, run_incremental_triggers, run_scheduled_listing,
    run_triggered_listing, schedule,
)
from tidemark.streaming.message_stream import dedupe_messages, run_message_routes

__all__ = ["EntityListing", "TimestampListing", "TriggeredListing", "dedupe_messages", "run_incremental_triggers",
           "run_message_routes", "run_scheduled_listing", "run_triggered_listing", "schedule", "track_entities_stream"]
