"""Named queries over the benchmark tables, each with the SQL that checks it."""

from __future__ import annotations

from retinue.catalog import jobs, operators  # noqa: F401  (they fill the registry)
from retinue.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
