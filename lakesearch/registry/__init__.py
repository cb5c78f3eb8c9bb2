"""Registered queries and their DuckDB oracles, one module per operator family."""

from importlib import import_module

FAMILIES = ["changes", "file_types", "analysis", "retrieval", "context", "conversations", "chunking", "embedding", "vectors", "sources", "streaming"]

QUERIES = {}
ORACLES = {}
for _family in FAMILIES:
    _module = import_module(f"lakesearch.registry.{_family}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
