"""Sources (catalog readers, test-table adapter) and sinks."""

from .fixtures import AS_OF as FIXTURE_AS_OF
from .fixtures import fixture_inputs
from .sinks import backup_table, preview, recent_rows, refresh_table, write_table
from .tables import (
    COST_SOURCE_NAMES,
    DEFAULT_TABLES,
    CostInputs,
    select_budget,
    select_cost_source,
    select_norm_curve,
    select_schedule,
)

__all__ = [
    "COST_SOURCE_NAMES",
    "DEFAULT_TABLES",
    "FIXTURE_AS_OF",
    "CostInputs",
    "backup_table",
    "fixture_inputs",
    "preview",
    "recent_rows",
    "refresh_table",
    "select_budget",
    "select_cost_source",
    "select_norm_curve",
    "select_schedule",
    "write_table",
]
