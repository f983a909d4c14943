"""All registered queries."""

from __future__ import annotations

from riskweave.plans import (  # noqa: F401
    queries_marts, queries_quality, queries_scoring, queries_sources,
)
from riskweave.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
