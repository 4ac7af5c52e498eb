"""Operators bound to the shared test tables."""

from casewise.plans import (  # noqa: F401  (each module registers its queries)
    classifying,
    cleaning,
    clustering,
    corpora,
    evaluating,
    exploring,
    preparing,
    profiling,
    scoring,
)
from casewise.plans.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
