"""All registered queries."""

from meterwatch.plans import detector_queries, model_queries, relational_queries, series_queries  # noqa: F401
from meterwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
