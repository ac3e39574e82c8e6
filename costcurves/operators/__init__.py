"""Relational operators of the four curve stages and the quality checks."""

from .actuals import (
    actual_value,
    budget_rollup,
    enrich_actuals,
    net_actuals,
    schedule_for_actuals,
    union_cost_sources,
)
from .combine import CURVE_TYPES, combined_curves
from .forecast import (
    actual_position,
    actuals_summary,
    forecast_value,
    future_weights,
    last_cumulative,
    remaining_amount,
)
from .planned import (
    curve_lookup,
    dedup_and_accumulate,
    norm_curve_points,
    planned_daily,
    planned_inputs,
    planned_value,
)
from . import quality

__all__ = [
    "CURVE_TYPES",
    "actual_position",
    "actual_value",
    "actuals_summary",
    "budget_rollup",
    "combined_curves",
    "curve_lookup",
    "dedup_and_accumulate",
    "enrich_actuals",
    "forecast_value",
    "future_weights",
    "last_cumulative",
    "net_actuals",
    "norm_curve_points",
    "planned_daily",
    "planned_inputs",
    "planned_value",
    "quality",
    "remaining_amount",
    "schedule_for_actuals",
    "union_cost_sources",
]
