"""All registered queries of the library and their SQL."""

from __future__ import annotations

from docmeter.plans import document_queries, more_queries  # noqa: F401  register their queries
from docmeter.plans.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
