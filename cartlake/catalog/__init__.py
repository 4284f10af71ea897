"""Registered queries: the operators bound to the driver's tables, each with its SQL."""

from cartlake.catalog import alerting, curated, enrichment, events, history, kpi, lake, quality, state, streams  # noqa: F401
from cartlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
