"""Every registered query of the library and its DuckDB twin."""

from __future__ import annotations

from . import accounts, payload_queries, relational  # accounts registers its queries with relational

QUERIES: dict = relational.QUERIES | payload_queries.QUERIES
ORACLE_SQL: dict[str, str] = relational.ORACLE_SQL | payload_queries.ORACLE_SQL
