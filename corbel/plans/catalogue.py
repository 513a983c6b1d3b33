"""All registered queries and oracles."""

from __future__ import annotations

from corbel.plans import (  # noqa: F401  (each module registers its queries)
    aggregates,
    filters,
    joins,
    layout,
    nested,
    nulls,
    projections,
    scalars,
    sqltext,
    storage,
)
from corbel.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
