"""Registered queries: each pairs a Spark plan with the SQL that checks it."""

from catalog.base import REGISTRY
from catalog import (  # noqa: F401
    evaluating,
    monitoring,
    screening,
    sourcing,
    calendars,
    whole_runs,
    feature_building,
    forecasting,
    profiling,
    regularizing,
)

__all__ = ["REGISTRY"]
