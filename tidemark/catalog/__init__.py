"""The registered queries with their SQL oracles."""

from tidemark.catalog.registry import ORACLES, QUERIES
from tidemark.catalog import files, functions, listings, messages, tracking, transfers  # noqa: F401  (registration)

__all__ = ["ORACLES", "QUERIES"]
