"""Queries over the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from petrichor.workload.base import ORACLES, QUERIES

from petrichor.workload import models, relational, statistics, storage, texts, weather  # noqa: E402,F401  isort:skip

__all__ = ["ORACLES", "QUERIES"]
