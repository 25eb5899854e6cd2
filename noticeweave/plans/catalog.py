"""All queries over the driver's tables."""

from __future__ import annotations

from noticeweave.plans import entities, files, linkage, master, metrics, records, streams, texts  # noqa: F401  they register themselves
from noticeweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
