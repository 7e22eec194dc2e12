"""All registered queries and their oracle SQL."""

from __future__ import annotations

from carelake.plans import claims_queries, lake_queries, records_queries, retrieval_queries

_MODULES = [claims_queries, records_queries, retrieval_queries, lake_queries]


def queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
