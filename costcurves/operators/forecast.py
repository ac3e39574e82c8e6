"""Forecast curve: the remaining budget spread over the future planned curve.

For each key with actuals and a plan, the planned values dated after
``as_of`` are the weights. The remaining amount ``max(0, budget - spent)``
is distributed in proportion to them and accumulated on top of the last
running actual cost.

Plan shape: the actual curve is reduced to one row per key in a single
aggregate (total, budget, last date and last running cost together), joined
once to the future planned rows; the future total and the running weight
come from one window on the key (no self-join to a per-key total).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import add_days, as_of_midnight
from ..schema import AMOUNT, FORECAST_COLUMNS, KEY
from .planned import amount_to_date, curve_kind, is_exact, money_parts, planned_amount, planned_by_key, planned_rows, planned_value


def actual_position(actual: DataFrame) -> DataFrame:
    """A5 and W3 fused: per key, total actual cost, (max) approved budget, last date and
    last running cost, in one partial-aggregatable pass over the actual curve.

    An aggregate rather than a ranking window: ``max_by`` keeps one candidate
    per key in each map task, so a key's rows are never gathered in one place
    (invoice dates are unique per key, so the latest row is well defined).
    """
    return actual.groupBy(*KEY).agg(
        F.sum("ACTUALS_COST").alias("TOTAL_ACTUAL_COST"),
        F.max("BUDGET_CURRENT_APPROVED").alias("BUDGET_CURRENT_APPROVED"),
        F.max("INVOICE_DATE").alias("INVOICE_DATE"),
        F.max_by("CUMULATIVE_ACTUAL_COST", F.col("INVOICE_DATE")).alias("CUMULATIVE_ACTUAL_COST"),
    )


def actuals_summary(actual: DataFrame) -> DataFrame:
    """A5: per key, total actual cost and the (max) approved budget."""
    return actual_position(actual).select(*KEY, "TOTAL_ACTUAL_COST", "BUDGET_CURRENT_APPROVED")


def last_cumulative(actual: DataFrame) -> DataFrame:
    """Latest row per key by invoice date (top-1 per group)."""
    return actual_position(actual).select(*KEY, "INVOICE_DATE", "CUMULATIVE_ACTUAL_COST")


def future_weights(planned: DataFrame, actual: DataFrame, as_of=None, position: DataFrame | None = None) -> DataFrame:
    """J5 + P7: future planned rows of keys that have actuals (inner joins),
    with the key's actual position. The date predicate is pushed below the
    join into the planned scan. ``position``: that of ``actual``, if known."""
    future = planned.filter(F.col("DATE") > as_of_midnight(as_of)).select(
        *KEY, "DATE", "NORMALIZED_PERCENT", "PLANNED_CURVE_VALUE", "CUMULATIVE_PLANNED_CURVE")
    return future.join(actual_position(actual) if position is None else position, KEY, "inner")


def _share(part: Column, total: Column) -> Column:
    """Part / total in double, 0 when the total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(part.cast("double") / total.cast("double"))


def remaining_amount(budget: Column, spent: Column) -> Column:
    """max(0, budget - spent); NULL when either side is NULL."""
    return F.when(budget.isNull() | spent.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(0).cast(AMOUNT), (budget.cast(AMOUNT) - spent.cast(AMOUNT)).cast(AMOUNT)))


def forecast_value(planned: DataFrame, actual: DataFrame, as_of=None, position: DataFrame | None = None) -> DataFrame:
    """The FORECASTVALUE curve.

    FORECAST_VALUE = share(planned, future total) * remaining (A6, P17-P19).
    The running forecast (W4) is remaining * share(running planned, total):
    the running sum is taken over exact decimals, so the result does not
    depend on the order in which partial sums are added (P20 adds the last
    running actual cost).
    """
    fw = future_weights(planned, actual, as_of, position)
    ordered = Window.partitionBy(*KEY).orderBy("DATE")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    remaining = remaining_amount(F.col("BUDGET_CURRENT_APPROVED"), F.col("TOTAL_ACTUAL_COST"))
    staged = fw.select(
        *KEY, "DATE", "PLANNED_CURVE_VALUE", "CUMULATIVE_ACTUAL_COST",
        F.sum("PLANNED_CURVE_VALUE").over(whole).alias("FUTURE_PLANNED_TOTAL"),
        F.sum("PLANNED_CURVE_VALUE").over(running).alias("RUNNING_PLANNED"),
        remaining.alias("REMAINING_AMOUNT"),
    )
    total = F.col("FUTURE_PLANNED_TOTAL")
    rem = F.col("REMAINING_AMOUNT").cast("double")
    cum_forecast = _share(F.col("RUNNING_PLANNED"), total) * rem
    return staged.select(
        *KEY,
        F.col("DATE").alias("FORECAST_DATE"),
        (_share(F.col("PLANNED_CURVE_VALUE"), total) * rem).alias("FORECAST_VALUE"),
        (cum_forecast + F.col("CUMULATIVE_ACTUAL_COST").cast("double")).alias("FORECAST_FINAL_VALUE"),
    ).select(*FORECAST_COLUMNS)


def future_by_key(budget: DataFrame, schedule: DataFrame, curve: DataFrame, actual: DataFrame, as_of=None,
                  method: str = "bucket", position: DataFrame | None = None) -> DataFrame:
    """``planned_by_key`` of keys that have actuals, with the key's actual position (the actual curve's budget as
    ACTUAL_BUDGET) and ``CURVE`` cut to the days after ``as_of``. For exact curves. ``position``: that of ``actual``, if
    known; the curve's rows are then not made for it."""
    position = actual_position(actual) if position is None else position
    rows = planned_by_key(budget, schedule, curve, method, position.withColumnRenamed("BUDGET_CURRENT_APPROVED", "ACTUAL_BUDGET"))
    midnight, start = as_of_midnight(as_of), F.col("CURRENTSTART")
    # The last day that is not after it: whole days since the start.
    past = F.when(start > midnight, F.lit(-1)).otherwise(F.extract(F.lit("DAY"), midnight - start)).cast("long")
    return rows.withColumn("_PAST", past).withColumn("CURVE", F.filter("CURVE", lambda x: x["DAY"] > F.col("_PAST"))).drop("_PAST")


def future_weights_of_inputs(budget: DataFrame, schedule: DataFrame, curve: DataFrame, actual: DataFrame, as_of=None,
                             method: str = "bucket", position: DataFrame | None = None) -> DataFrame:
    """``future_weights`` of the planned curve of these inputs: a key meets its actual position before it has curve rows."""
    if not is_exact(curve_kind(curve)):
        return future_weights(planned_value(budget, schedule, curve, method), actual, as_of, position)
    rows = planned_rows(future_by_key(budget, schedule, curve, actual, as_of, method, position))
    return rows.withColumnRenamed("ACTUAL_BUDGET", "BUDGET_CURRENT_APPROVED").select(
        *KEY, "DATE", "NORMALIZED_PERCENT", "PLANNED_CURVE_VALUE", "CUMULATIVE_PLANNED_CURVE",
        "TOTAL_ACTUAL_COST", "BUDGET_CURRENT_APPROVED", "INVOICE_DATE", "CUMULATIVE_ACTUAL_COST")


def forecast_of_inputs(budget: DataFrame, schedule: DataFrame, curve: DataFrame, actual: DataFrame, as_of=None,
                       method: str = "bucket", position: DataFrame | None = None) -> DataFrame:
    """``forecast_value`` of the planned curve of these inputs, without a window over its rows.

    The running total of the future rows is the curve's own, less what it had reached before them.
    """
    kind = curve_kind(curve)
    if not is_exact(kind):
        return forecast_value(planned_value(budget, schedule, curve, method), actual, as_of, position)
    rows = future_by_key(budget, schedule, curve, actual, as_of, method, position)
    first, last = F.get("CURVE", F.lit(0)), F.element_at("CURVE", -1)
    sums = rows.schema["CURVE"].dataType.elementType["TO_DATE"].dataType
    rows = rows.filter(F.size("CURVE") > 0).withColumns({
        "_BEFORE": (first["TO_DATE"] - first["VALUE"]).cast(sums), "_LAST": last["TO_DATE"],
        "_REMAINING": remaining_amount(F.col("ACTUAL_BUDGET"), F.col("TOTAL_ACTUAL_COST")).cast("double"),
        "_SPENT": F.col("CUMULATIVE_ACTUAL_COST").cast("double")})
    rows = rows.select(*KEY, "CURRENTSTART", "CURVE", "_BEFORE", "_LAST", "_REMAINING", "_SPENT",
                       *money_parts(F.col("BUDGET_CURRENT_APPROVED"), kind))
    rows = rows.withColumn("_TOTAL", amount_to_date((F.col("_LAST") - F.col("_BEFORE")).cast(sums), kind))
    rows = rows.select(*[c for c in rows.columns if c not in ("CURVE", "_LAST")], F.inline("CURVE"))
    total, rest = F.col("_TOTAL"), F.col("_REMAINING")
    running = amount_to_date((F.col("TO_DATE") - F.col("_BEFORE")).cast(sums), kind)
    return rows.select(
        *KEY, add_days(F.col("CURRENTSTART"), F.col("DAY")).alias("FORECAST_DATE"),
        (_share(planned_amount(F.col("VALUE"), kind, F.col("_MONEY")), total) * rest).alias("FORECAST_VALUE"),
        (_share(running, total) * rest + F.col("_SPENT")).alias("FORECAST_FINAL_VALUE")).select(*FORECAST_COLUMNS)
