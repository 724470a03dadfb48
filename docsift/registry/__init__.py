"""All registered queries and their SQL twins."""

from docsift.registry import chunking, indexing, parsing, searching  # noqa: F401
from docsift.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
