"""Ready-made queries over the given tables, each beside the SQL that says the same."""

from tablework.plans.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
