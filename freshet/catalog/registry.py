"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

MODULES = ("event_queries", "chunk_queries", "sync_queries", "search_queries", "further_queries")


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in MODULES:
        found.update(import_module(f"freshet.catalog.{module}").QUERIES)
    return found
