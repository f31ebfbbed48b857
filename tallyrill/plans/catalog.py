"""All registered queries and their SQL statements."""

from tallyrill.plans import analysis_queries, order_queries, rollup_queries, source_queries, storage_queries  # noqa: F401
from tallyrill.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
