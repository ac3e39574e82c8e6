"""Readers for the source tables (renamed to the canonical key names).

Every reader is a projection, so Catalyst prunes the scan to the columns used
and pushes later filters into it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import to_timestamp_strict

# Default catalog names of the six inputs.
DEFAULT_TABLES = {
    "invoice": "INVOICE",
    "pay_app": "PAY_APP",
    "pay_req": "PAY_REQ",
    "budget": "UNIFIER_COSTSHEET_SUBSTAGE_FUND",
    "schedule": "P6_SCHEDULE",
    "norm_curve": "NORM_BRGSPENDINGCURVES_SUBSTAGE_0_TO_1",
}

COST_SOURCE_NAMES = ("INVOICE", "PAY_APP", "PAY_REQ")


def select_cost_source(df: DataFrame) -> DataFrame:
    """A cost source (invoice, pay application, pay request) in canonical names."""
    return df.select(
        F.col("PROJECTID").alias("PROJECT_NUMBER"),
        F.col("STAGEPHASE_CODE").alias("STAGE"),
        F.col("SUBSTAGEACTIVITY_CODE").alias("SUB_STAGE"),
        F.col("INVOICE_DATE"),
        F.col("ACTUALS_COST"),
    )


def select_budget(df: DataFrame) -> DataFrame:
    """Fund-level budget rows (several per key)."""
    return df.select("PROJECT_NUMBER", "STAGE", "SUB_STAGE", "BUDGET_CURRENT_APPROVED")


def select_schedule(df: DataFrame) -> DataFrame:
    """Schedule rows in canonical names (a key may repeat). Dates are converted strictly (P9):
    text, DATE and timestamp schedules read alike, unreadable text raises."""
    return df.select(
        F.col("PROJECTID").alias("PROJECT_NUMBER"),
        F.col("STAGECODE").alias("STAGE"),
        F.col("STAGESUBSTAGECODE").alias("SUB_STAGE"),
        to_timestamp_strict(df, "CURRENTSTART").alias("CURRENTSTART"),
        to_timestamp_strict(df, "CURRENTEND").alias("CURRENTEND"),
    )


def select_norm_curve(df: DataFrame) -> DataFrame:
    """Normalized spending curve points."""
    return df.select("SUBSTAGES", "PERCENT_COMPLETIONTIME", "NORM_PERCENT_CUMSPENT")


@dataclass(frozen=True)
class CostInputs:
    """The six inputs, as DataFrames in their source schemas."""

    invoice: DataFrame
    pay_app: DataFrame
    pay_req: DataFrame
    budget: DataFrame
    schedule: DataFrame
    norm_curve: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, tables: dict[str, str] | None = None) -> "CostInputs":
        names = {**DEFAULT_TABLES, **(tables or {})}
        return cls(**{field: spark.table(name) for field, name in names.items()})

    def cost_sources(self) -> dict[str, DataFrame]:
        """Cost sources by their upstream table name."""
        return dict(zip(COST_SOURCE_NAMES, (self.invoice, self.pay_app, self.pay_req)))
