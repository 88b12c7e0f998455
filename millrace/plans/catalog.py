"""All registered queries."""

from __future__ import annotations

from millrace.plans import lineage, log, monitoring, quality, reads, storage, streams
from millrace.plans.registry import ORACLES, QUERIES, Query

__all__ = ["ORACLES", "QUERIES", "Query", "lineage", "log", "monitoring", "quality", "reads", "storage", "streams"]
