"""The registry of named queries, each with its DuckDB SQL where SQL can express it."""

from fernglass.plans.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
