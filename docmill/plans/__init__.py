"""Named queries and the SQL that says the same."""

from . import analytics, documents, placed, records, relational, scalars, sqltext, streams
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "documents", "placed", "records", "relational", "scalars", "sqltext", "streams"]
