"""Registered queries and their SQL."""

from barloom.catalog import indicators, pages, streams, tables  # noqa: F401
from barloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
