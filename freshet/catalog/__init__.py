"""Named queries over the test tables, each with the SQL that must give the same rows."""

from freshet.catalog.registry import all_queries

__all__ = ["all_queries"]
