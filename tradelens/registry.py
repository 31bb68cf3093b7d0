"""Named queries of the library over the driver tables, with the SQL they are checked against."""

from __future__ import annotations

from tradelens.plans import expressions, paper_queries, report_queries, signal_queries, source_queries, store_queries, study_queries  # noqa: F401
from tradelens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
