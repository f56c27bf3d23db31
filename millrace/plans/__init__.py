"""Registered queries on the driver's tables."""

from millrace.plans import aggregating, composing, documents, expressions, joining, relational, validating  # noqa: F401  they register
from millrace.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
