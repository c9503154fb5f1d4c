"""Registered queries: every operator over the whole test tables, with its SQL twin."""

from gaugeline.catalog import base, forecasts, records, series, streams, warning_log  # noqa: F401
from gaugeline.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
