"""Column names and types shared by every stage.

The source system declares no DDL, so the types are ours. Money is carried as
exact decimals (sums, zero-sum removal and running totals must not depend on
summation order) at the scale of the source; text and double amounts get
``FREE_SCALE`` decimal places. Curve values keep their source type. Only the
forecast ratio is computed in double.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Common grouping key of every curve: project, stage, sub-stage.
KEY = ["PROJECT_NUMBER", "STAGE", "SUB_STAGE"]

COST = T.DecimalType(18, 2)        # one invoice line, as the source catalog types it
FREE_SCALE = 10                    # decimal places of amounts that come as text or double
MONEY_DIGITS = 38                  # digits of sums and running totals
AMOUNT = T.DecimalType(37, 10)     # budget vs spent comparisons (a difference has 38 digits)
NORM = T.DecimalType(9, 6)         # normalized cumulative spend 0..1, as the source catalog types it


def amount_type(source: T.DataType) -> T.DecimalType:
    """Exact type of summed amounts of a source column: its own scale, or FREE_SCALE."""
    if isinstance(source, T.DecimalType):
        return T.DecimalType(MONEY_DIGITS, source.scale)
    if isinstance(source, T.IntegralType):
        return T.DecimalType(MONEY_DIGITS, 0)
    return T.DecimalType(MONEY_DIGITS, FREE_SCALE)


# Source schemas as read from the catalog (names as the upstream systems spell them).
COST_SOURCE = T.StructType([
    T.StructField("PROJECTID", T.StringType()),
    T.StructField("STAGEPHASE_CODE", T.StringType()),
    T.StructField("SUBSTAGEACTIVITY_CODE", T.StringType()),
    T.StructField("INVOICE_DATE", T.TimestampNTZType()),
    T.StructField("ACTUALS_COST", COST),
])

BUDGET_SOURCE = T.StructType([
    T.StructField("PROJECT_NUMBER", T.StringType()),
    T.StructField("STAGE", T.StringType()),
    T.StructField("SUB_STAGE", T.StringType()),
    T.StructField("BUDGET_CURRENT_APPROVED", T.DecimalType(20, 4)),
])

SCHEDULE_SOURCE = T.StructType([
    T.StructField("PROJECTID", T.StringType()),
    T.StructField("STAGECODE", T.StringType()),
    T.StructField("STAGESUBSTAGECODE", T.StringType()),
    T.StructField("CURRENTSTART", T.TimestampNTZType()),
    T.StructField("CURRENTEND", T.TimestampNTZType()),
])

CURVE_SOURCE = T.StructType([
    T.StructField("SUBSTAGES", T.StringType()),
    T.StructField("PERCENT_COMPLETIONTIME", T.DoubleType()),
    T.StructField("NORM_PERCENT_CUMSPENT", NORM),
])

# Output column orders.
ACTUAL_COLUMNS = KEY + [
    "INVOICE_DATE", "ACTUALS_COST", "BUDGET_CURRENT_APPROVED",
    "CURRENTSTART", "CURRENTEND", "CUMULATIVE_ACTUAL_COST",
]
PLANNED_COLUMNS = KEY + [
    "NORMALIZED_PERCENT", "DATE", "PLANNED_CURVE_VALUE", "CUMULATIVE_PLANNED_CURVE",
]
FORECAST_COLUMNS = KEY + ["FORECAST_DATE", "FORECAST_VALUE", "FORECAST_FINAL_VALUE"]
COMBINED_COLUMNS = KEY + ["DATE", "VALUE", "TYPE"]

# Default table names of the four stage outputs.
ACTUAL_TABLE = "ACTUALVALUE"
PLANNED_TABLE = "PLANNEDVALUE"
FORECAST_TABLE = "FORECASTVALUE"
COMBINED_TABLE = "COMBINED_CURVES"
