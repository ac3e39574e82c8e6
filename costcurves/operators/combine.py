"""Combined curves: actual, planned and forecast stacked into one reporting table.

A narrow union (no shuffle): each branch is a projection of its stage output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import key_as_string, to_double_or_zero, to_timestamp_strict
from ..schema import COMBINED_COLUMNS, KEY

CURVE_TYPES = ("ACTUAL", "PLANNED", "FORECAST")


def _branch(df: DataFrame, date_col: str, value_col: str, curve_type: str) -> DataFrame:
    """P1 + P3 + P8-P10: one curve as (key, DATE, VALUE, TYPE)."""
    return df.select(
        *[key_as_string(k) for k in KEY],
        to_timestamp_strict(df, date_col).alias("DATE"),
        to_double_or_zero(df, value_col).alias("VALUE"),
        F.lit(curve_type).alias("TYPE"),
    )


def combined_curves(actual: DataFrame, planned: DataFrame, forecast: DataFrame) -> DataFrame:
    """The COMBINED_CURVES table."""
    return (
        _branch(actual, "INVOICE_DATE", "CUMULATIVE_ACTUAL_COST", "ACTUAL")
        .unionByName(_branch(planned, "DATE", "PLANNED_CURVE_VALUE", "PLANNED"))
        .unionByName(_branch(forecast, "FORECAST_DATE", "FORECAST_FINAL_VALUE", "FORECAST"))
        .select(*COMBINED_COLUMNS)
    )
