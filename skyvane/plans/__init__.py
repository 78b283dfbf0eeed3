"""Registered queries (Spark builders with their DuckDB oracles)."""

from . import wing, wing_rules, wing_streams  # noqa: F401 - they register the wing feed's queries
from .catalog import REGISTRY

__all__ = ["REGISTRY"]
