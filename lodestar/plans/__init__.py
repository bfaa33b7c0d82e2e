"""Registered queries; importing this package fills the registry."""

from lodestar.plans import classifier_plans, metric_plans, mixture_plans, source_plans, stat_plans, tabular_plans, text_plans, trip_plans  # noqa: F401
from lodestar.plans.registry import NOTES, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "NOTES"]
