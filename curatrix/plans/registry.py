"""Queries of the library's own operators and their SQL."""

from __future__ import annotations

from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
