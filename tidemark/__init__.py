"""File inventory and event ingest on Spark."""
