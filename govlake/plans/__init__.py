"""Registered queries (Spark builders + DuckDB oracle SQL)."""

from .registry import REGISTRY, Query  # noqa: F401
from . import catalog, catalog_rules, catalog_state  # noqa: F401  (registers the queries)
