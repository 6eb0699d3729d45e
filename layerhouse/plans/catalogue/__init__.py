"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from layerhouse.plans.catalogue.registry import QUERIES, SQL
from layerhouse.plans.catalogue import checks, conversion, dimensions, sales, sinks, synthetic  # noqa: F401

__all__ = ["QUERIES", "SQL"]
