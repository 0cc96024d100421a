"""Imports every module that registers queries."""

from checks import (  # noqa: F401
    analytics_queries,
    control_queries,
    data_queries,
    lineage_queries,
    publish_queries,
)
from checks.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
