"""Registered queries; all modules fill one registry."""

from lectern.plans import function_queries, queries, work_queries

__all__ = ["function_queries", "queries", "work_queries"]
