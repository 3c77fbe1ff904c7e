"""Every registered query of the engine and its oracle SQL. The cases of literal_queries read no table: the tests run them."""

from __future__ import annotations

from siltstone.plans import case_queries, site_queries, table_queries

QUERIES: dict = table_queries.QUERIES | site_queries.QUERIES | case_queries.QUERIES
ORACLE_SQL: dict = table_queries.ORACLE_SQL | site_queries.ORACLE_SQL | case_queries.ORACLE_SQL
