"""Composite jobs: the four curve stages."""

from .jobs import (
    Curves,
    build_curves,
    quality_score,
    run_actual_stage,
    run_combined_stage,
    run_curves,
    run_forecast_stage,
    run_planned_stage,
    stored_curves,
)

__all__ = [
    "Curves",
    "build_curves",
    "quality_score",
    "run_actual_stage",
    "run_combined_stage",
    "run_curves",
    "run_forecast_stage",
    "run_planned_stage",
    "stored_curves",
]
