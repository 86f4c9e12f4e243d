"""All queries of the episode engine, with their DuckDB counterparts."""

from __future__ import annotations

from marquetry.plans import discovery_queries, mask_queries, product_queries, table_queries, text_queries

_MODULES = (text_queries, discovery_queries, table_queries, mask_queries, product_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
