"""Registered queries, each with the SQL that must give the same rows."""

from moodlake.catalog import clusters, records, scores, streams, summaries, transport  # noqa: F401
from moodlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
