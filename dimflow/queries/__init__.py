"""Registered queries: every operator on the given tables, with its SQL equivalent."""

from dimflow.queries.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
