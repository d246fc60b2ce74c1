"""Registered queries and the SQL that checks them."""

from linkloom.catalog import cells, dumps, links, ranking, vectors  # noqa: F401
from linkloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
