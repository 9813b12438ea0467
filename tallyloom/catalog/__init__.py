"""Registered queries: every operator and job over the given tables, with its SQL twin."""

from tallyloom.catalog import dividends, entities, landing, macro, prices, relational, tables  # noqa: F401
from tallyloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
