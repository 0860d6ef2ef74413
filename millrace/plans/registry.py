"""Every query on the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from millrace.plans import log_queries, source_queries, text_queries  # noqa: F401  they register their queries
from millrace.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
