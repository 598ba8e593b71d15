"""Registered analyses (Spark) and their DuckDB twins (oracle SQL)."""

from tablecraft.plans.oracle import oracle_sql
from tablecraft.plans.registry import queries

__all__ = ["oracle_sql", "queries"]
