"""Registered queries and the SQL that checks them."""

from fleetlens.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
