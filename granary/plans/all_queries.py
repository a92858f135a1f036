"""All of the library's queries, registered by importing their modules."""

from __future__ import annotations

from granary.plans import alignment_queries, base_queries, coverage_queries, model_queries, more_queries, read_queries, report_queries, signal_queries, stream_queries, table_queries
from granary.plans.catalog import ORACLE_SQL, QUERIES

MODULES = (alignment_queries, base_queries, coverage_queries, model_queries, more_queries, read_queries, report_queries, signal_queries, stream_queries, table_queries)

__all__ = ["MODULES", "ORACLE_SQL", "QUERIES"]
