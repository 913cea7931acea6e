"""All registered queries."""

from workload import q_aggregates, q_features, q_governance, q_joins, q_models, q_scalars, q_sources, q_statistics  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
