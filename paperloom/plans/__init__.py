"""All queries of the engine, and the SQL that checks them."""

from paperloom.plans import layout_queries, ops_queries, record_queries, search_queries, text_queries
from paperloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "layout_queries", "ops_queries", "record_queries", "search_queries", "text_queries"]
