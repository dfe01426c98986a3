"""All registered queries."""

from workload import queries_analytics, queries_mechanisms, queries_models, queries_operators, queries_silver, queries_usage  # noqa: F401
from workload.registry import QUERIES

__all__ = ["QUERIES"]
