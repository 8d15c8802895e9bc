"""Continuous-query analytics over event streams, on Spark DataFrames."""

from tidemark.config import (
    Aggregation,
    ConfigError,
    DerivedMetric,
    Filter,
    QueryConfig,
    SummaryUpdate,
    WindowSpec,
)
from tidemark.plans.run import run_metrics, run_query, run_sql, run_tick

__all__ = [
    "Aggregation",
    "ConfigError",
    "DerivedMetric",
    "Filter",
    "QueryConfig",
    "SummaryUpdate",
    "WindowSpec",
    "run_metrics",
    "run_query",
    "run_sql",
    "run_tick",
]
