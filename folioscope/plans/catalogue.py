"""All registered queries of the corpus verification engine."""

from __future__ import annotations

from . import corpus_queries, verify_queries  # noqa: F401  (they register)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
