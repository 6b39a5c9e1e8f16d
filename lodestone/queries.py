"""All core queries: importing this module registers them."""

from __future__ import annotations

from lodestone.plans import data_quality, reference_queries, relation_queries, source_queries  # noqa: F401  (they register their queries)
from lodestone.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL", "query"]
