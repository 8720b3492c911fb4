"""Registered queries and their SQL checks."""

from daybook.catalog import ingest, reports, structures  # noqa: F401  (registers the queries)
from daybook.catalog.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
