"""Queries over the given tables, each with the SQL it must agree with."""

from syncspark.queries import changes, messages, quality, streams, sync  # noqa: F401
from syncspark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
