"""Binding of the operators to the check tables, with SQL to compare against."""

from checks import analytics, histories, ingest, relational  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
