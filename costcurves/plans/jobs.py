"""The four-stage job: actual -> planned -> forecast -> combined.

``build_curves`` composes the stages lazily (one Spark plan per output).
``run_curves`` runs them as the upstream job does, writing each stage to a
table and reading the written table back for the next stage: the written
tables cut the lineage, so a lost executor re-runs at most one stage, and
downstream stages read the pruned, typed parquet instead of re-planning the
sources.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.actuals import actual_value, position_of_costs
from ..operators.combine import combined_curves
from ..operators.forecast import actual_position, forecast_of_inputs, forecast_value
from ..operators.planned import curve_kind, is_exact, planned_value
from ..schema import ACTUAL_TABLE, COMBINED_TABLE, FORECAST_TABLE, KEY, PLANNED_TABLE
from ..session import shared_folder
from ..sources.sinks import preview, write_table
from ..sources.tables import CostInputs, select_budget


@dataclass(frozen=True)
class Curves:
    actual: DataFrame
    planned: DataFrame
    forecast: DataFrame
    combined: DataFrame
    #: ``actual_position`` of the actual curve, if known.
    position: DataFrame | None = None


def build_curves(inputs: CostInputs, as_of=None, planned_method: str = "bucket") -> Curves:
    """All four outputs as lazy DataFrames over the inputs."""
    sources = [inputs.invoice, inputs.pay_app, inputs.pay_req]
    actual = actual_value(sources, inputs.budget, inputs.schedule)
    position = position_of_costs(sources, inputs.budget, inputs.schedule)
    planned = planned_value(inputs.budget, inputs.schedule, inputs.norm_curve, method=planned_method)
    forecast = forecast_of_inputs(inputs.budget, inputs.schedule, inputs.norm_curve, actual, as_of, planned_method, position)
    return Curves(actual, planned, forecast, combined_curves(actual, planned, forecast), position)


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket_count(spark: SparkSession, table: str) -> int | None:
    """The number of buckets of a table that is bucketed on the key."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    on_key = re.findall(r"\w+", about.get("Bucket Columns", "")) == KEY
    return int(about["Num Buckets"]) if on_key and about.get("Num Buckets", "").isdigit() else None


def run_actual_stage(spark: SparkSession, inputs: CostInputs, table: str = ACTUAL_TABLE) -> None:
    """Stage 1: write the actual curve. It is not bucketed: one key may hold a third of its rows."""
    write_table(actual_value([inputs.invoice, inputs.pay_app, inputs.pay_req], inputs.budget, inputs.schedule), table)


def run_planned_stage(spark: SparkSession, inputs: CostInputs, table: str = PLANNED_TABLE,
                      planned_method: str = "bucket", buckets: int | None = None) -> None:
    """Stage 2: write the planned curve (bucketed on the key)."""
    n = _buckets(spark, buckets)
    # Keys are dealt to the buckets before they have curve rows.
    df = planned_value(inputs.budget, inputs.schedule, inputs.norm_curve, planned_method, n)
    write_table(df, table, bucket_by=KEY, buckets=n, dealt=is_exact(curve_kind(inputs.norm_curve)))


def run_forecast_stage(spark: SparkSession, as_of=None, actual_table: str = ACTUAL_TABLE,
                       planned_table: str = PLANNED_TABLE, table: str = FORECAST_TABLE,
                       buckets: int | None = None) -> None:
    """Stage 3: read the two written curves and write the forecast curve."""
    df = forecast_value(spark.table(planned_table), spark.table(actual_table), as_of)
    n = _buckets(spark, buckets)
    # The planned table's buckets pass through join and window: the same count needs no shuffle.
    write_table(df, table, bucket_by=KEY, buckets=n, dealt=_bucket_count(spark, planned_table) == n)


def run_combined_stage(spark: SparkSession, actual_table: str = ACTUAL_TABLE,
                       planned_table: str = PLANNED_TABLE, forecast_table: str = FORECAST_TABLE,
                       table: str = COMBINED_TABLE) -> DataFrame:
    """Stage 4: stack the three written curves; returns a 10-row preview.

    The reporting table is partitioned by TYPE (three values), so readers
    filtering on one curve type read only its folder."""
    df = combined_curves(spark.table(actual_table), spark.table(planned_table),
                         spark.table(forecast_table))
    write_table(df, table, partition_by=["TYPE"])
    return preview(spark.table(table), 10)


def run_curves(spark: SparkSession, inputs: CostInputs, as_of=None,
               tables: dict[str, str] | None = None,
               planned_method: str = "bucket", buckets: int | None = None) -> DataFrame:
    """All four stages in order: ACTUALVALUE, PLANNEDVALUE, FORECASTVALUE,
    COMBINED_CURVES (overwrite), each later stage reading the tables written
    before it.

    Planned and forecast curves have at most 101 rows per key and are bucketed
    on the key with one bucket count, so the forecast stage reads co-located
    buckets and shuffles only the actual curve's per-key sums. Returns a
    10-row preview of the combined table."""
    names = {"actual": ACTUAL_TABLE, "planned": PLANNED_TABLE,
             "forecast": FORECAST_TABLE, "combined": COMBINED_TABLE, **(tables or {})}
    n = _buckets(spark, buckets)
    inputs = stored_plans(inputs)
    run_actual_stage(spark, inputs, names["actual"])
    run_planned_stage(spark, inputs, names["planned"], planned_method=planned_method, buckets=n)
    run_forecast_stage(spark, as_of, names["actual"], names["planned"], names["forecast"], buckets=n)
    return run_combined_stage(spark, names["actual"], names["planned"], names["forecast"],
                              names["combined"])


def stored_in(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """Write a table under a name in ``folder`` and read it back."""
    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return stored


def stored_plans(inputs: CostInputs) -> CostInputs:
    """``inputs`` with the used columns of budget and schedule written once to a new shared folder.

    Every curve and check reads both, which may be views over the facts.
    """
    stored = stored_in(shared_folder(inputs.budget.sparkSession, "plans"))
    schedule = inputs.schedule.select("PROJECTID", "STAGECODE", "STAGESUBSTAGECODE", "CURRENTSTART", "CURRENTEND")
    return replace(inputs, budget=stored(select_budget(inputs.budget), "budget"), schedule=stored(schedule, "schedule"))


def stored_curves(inputs: CostInputs, as_of=None, planned_method: str = "bucket") -> Curves:
    """The three curves written as Parquet to a new shared folder and read back: the checks
    then scan typed, column-pruned files, and a lost executor recomputes at most one curve."""
    return _stored_curves(stored_plans(inputs), as_of, planned_method)


def _stored_curves(inputs: CostInputs, as_of=None, planned_method: str = "bucket") -> Curves:
    stored = stored_in(shared_folder(inputs.invoice.sparkSession, "curves"))
    actual = stored(actual_value([inputs.invoice, inputs.pay_app, inputs.pay_req], inputs.budget, inputs.schedule),
                    "actual")
    planned = stored(planned_value(inputs.budget, inputs.schedule, inputs.norm_curve, method=planned_method), "planned")
    forecast = stored(forecast_of_inputs(inputs.budget, inputs.schedule, inputs.norm_curve, actual, as_of, planned_method),
                      "forecast")
    return Curves(actual, planned, forecast, combined_curves(actual, planned, forecast), actual_position(actual))


def dated_tables(inputs: CostInputs, actual: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The tables whose freshness is checked, with their date column."""
    out = {name: (df, "INVOICE_DATE") for name, df in inputs.cost_sources().items()}
    out["ACTUALVALUE"] = (actual, "INVOICE_DATE")
    return out


def quality_checks(inputs: CostInputs, curves: Curves, as_of=None) -> dict[str, DataFrame]:
    """Every scored check as a DataFrame of (checked, failed) rows."""
    c = curves
    sources = [inputs.invoice, inputs.pay_app, inputs.pay_req]
    return {
        "monotone": q.monotone_scored(c.actual),
        "planned_vs_budget": q.flagged(q.planned_vs_budget(c.planned, inputs.budget),
                                       F.col("STATUS") == "FAIL"),
        "forecast_continuity": q.flagged(q.forecast_continuity(c.actual, c.forecast),
                                         F.col("STATUS") == "FAIL"),
        "continuity": q.flagged(q.continuity_check(c.actual, c.forecast),
                                F.col("continuity_check") == "FAIL"),
        "completeness": q.completeness_scored(inputs.budget, c.actual, c.planned, c.forecast),
        "missing_keys": q.missing_keys_scored(inputs.budget, c.actual, c.planned, c.forecast),
        "control_totals": q.flagged(q.control_totals(sources, c.actual), F.col("STATUS") == "MISMATCH"),
        "freshness": q.flagged(q.freshness(dated_tables(inputs, c.actual), as_of), F.col("status") == "STALE"),
        "budget_alignment": q.flagged(q.budget_alignment(c.actual, c.forecast),
                                      F.col("STATUS") == "FAIL"),
        "timeline": q.timeline_scored(c.actual),
    }


def quality_score(inputs: CostInputs, as_of=None, curves: Curves | None = None) -> DataFrame:
    """D9 over the written stage tables; without them the curves are written first."""
    inputs = stored_plans(inputs)
    c = curves or _stored_curves(inputs, as_of)
    return q.score(list(quality_checks(inputs, c, as_of).items()))
