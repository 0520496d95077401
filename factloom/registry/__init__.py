"""Named queries over a data folder, each with the SQL that must give the same rows."""

from factloom.registry import gold, quality, relational, silver, sources, streams  # noqa: F401
from factloom.registry.base import oracles, queries

__all__ = ["oracles", "queries"]
