"""Registered queries and, written independently, the SQL another engine answers them with."""

from checks import aggregates, filters, lookups, reports, rows, scalars, sources  # noqa: F401
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
