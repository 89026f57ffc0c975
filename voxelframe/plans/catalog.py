"""Imports every query module so that the registry is complete."""

from voxelframe.plans import q_models, q_series, q_sources, q_stats, q_tables, q_udf  # noqa: F401
from voxelframe.plans.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
