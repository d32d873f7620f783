"""All registered queries. Importing this module registers every plan module."""

from __future__ import annotations

from kiln.plans import cleaning, files, models, neighbours, reports, series, statistics, streams, text  # noqa: F401
from kiln.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
