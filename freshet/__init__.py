"""freshet: keep a searchable table of embedded document chunks fresh, on Spark."""

from freshet.config import JobConfig

__all__ = ["JobConfig"]
