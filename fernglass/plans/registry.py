"""Collects the query modules: each has QUERIES (name -> builder) and SQL (name -> DuckDB text)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES: list[str] = ["filters", "joins", "aggregates", "scalars", "entities", "search", "rules", "flows", "misc", "roundtrip"]


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"fernglass.plans.{name}"), attribute)
        if twice := found.keys() & part.keys():
            raise ValueError(f"registered twice: {sorted(twice)}")
        found |= part
    return found


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def all_sql() -> dict[str, str]:
    return _merged("SQL")
