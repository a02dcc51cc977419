"""Operators of a training-data pipeline over documents, embeddings and pages."""

from tidemark.llm.registry import ORACLES, QUERIES
from tidemark.llm import embedding_dedup, hard_negatives, licenses, line_dedup, mixing, nearest, ngram_join, pieces, prefix_trie, secrets, toxicity, url_filter, warc  # noqa: F401  (registration)

__all__ = ["ORACLES", "QUERIES"]
