"""Registered queries: every operator bound to the test tables, with its SQL counterpart."""

from webloom.plans import index_queries, neardup_queries, recommend_queries, web_queries  # noqa: F401
from webloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
