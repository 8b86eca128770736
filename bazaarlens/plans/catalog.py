"""All named queries. Importing the modules registers them."""

from __future__ import annotations

from bazaarlens.plans import cleaning_queries, model_queries, page_queries
from bazaarlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning_queries", "model_queries", "page_queries"]
