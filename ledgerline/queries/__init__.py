"""Registered queries: every operator over a patent-shaped view of the given tables."""

from .oracle import ORACLE
from .registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]
