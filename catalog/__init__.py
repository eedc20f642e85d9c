"""The registered queries: every operator on the driver's tables, with its SQL twin."""

from catalog.base import ORACLES, QUERIES
from catalog import coordinates, enrichment, geography, lineage, names, temporal, terms, views  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
