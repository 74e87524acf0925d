"""Queries over the shared test tables, each next to the SQL that gives the same rows."""

from . import audit, cleaning, gold, incremental, insights, keys, payloads, sources, tokens  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
