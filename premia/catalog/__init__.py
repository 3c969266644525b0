"""Registered queries over the given tables."""

from premia.catalog import drift, features, landing, models, networks, quality  # noqa: F401
from premia.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
