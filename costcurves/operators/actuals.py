"""Actual cost curve: union of cost sources -> net cost per key and day -> running total.

Plan shape (see ``actual_value``): the cost sources are aggregated to one row
per (key, invoice date) with map-side partial sums *before* any join, so the
large fact rows are never shuffled whole, and those rows in turn are shuffled once,
by (key, block of days). Budget, schedule and the totals of earlier blocks reach
them through one row per (key, block): a key that holds a third of all costs is
spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import to_decimal_or_zero, to_timestamp_strict
from ..schema import ACTUAL_COLUMNS, KEY, MONEY_DIGITS, amount_type
from ..sources.tables import select_budget, select_cost_source, select_schedule

#: Days of a block of the running total.
DAYS = 256


def keys_present(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    cond = None
    for c in KEY + (extra or []):
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def union_cost_sources(*sources: DataFrame) -> DataFrame:
    """The cost sources stacked (union all) in canonical names.

    Sources of one type keep it. Where types differ (a source with text costs,
    say), costs are coerced first: exact decimals at the largest scale, bad
    values 0 (P8).
    """
    selected = [select_cost_source(s) for s in sources]
    kinds = [s.schema["ACTUALS_COST"].dataType for s in selected]
    if len(set(kinds)) > 1:
        exact = T.DecimalType(MONEY_DIGITS, max(amount_type(k).scale for k in kinds))
        selected = [s.withColumn("ACTUALS_COST", to_decimal_or_zero(s, "ACTUALS_COST", exact)) for s in selected]
    dates = {s.schema["INVOICE_DATE"].dataType for s in selected}
    if len(dates) > 1:
        selected = [s.withColumn("INVOICE_DATE", to_timestamp_strict(s, "INVOICE_DATE")) for s in selected]
    out = selected[0]
    for s in selected[1:]:
        out = out.unionByName(s)
    return out


def cost_amounts(actuals: DataFrame) -> Column:
    """ACTUALS_COST as an exact decimal at the source's scale, bad values 0."""
    return to_decimal_or_zero(actuals, "ACTUALS_COST", amount_type(actuals.schema["ACTUALS_COST"].dataType))


def budget_rollup(budget: DataFrame) -> DataFrame:
    """A1: budget summed over funds, one row per key (all-NULL funds -> NULL).

    A double or text budget is summed as an exact decimal, so the order of
    addition does not matter; unreadable text counts as missing.
    """
    b = select_budget(budget)
    kind = b.schema["BUDGET_CURRENT_APPROVED"].dataType
    amount = F.col("BUDGET_CURRENT_APPROVED")
    if not isinstance(kind, T.DecimalType):
        amount = amount.try_cast(amount_type(kind))
    return b.groupBy(*KEY).agg(F.sum(amount).alias("BUDGET_CURRENT_APPROVED"))


def enrich_actuals(actuals: DataFrame, budget_by_key: DataFrame, schedule: DataFrame) -> DataFrame:
    """J1 + J2: cost rows left-joined to the budget and to every schedule row of the key.

    A key with two schedule rows yields each cost row twice; this is the
    row-level form (the net curve uses the equivalent multiplier instead).

    ``a LEFT JOIN b LEFT JOIN s`` equals ``a LEFT JOIN (b FULL JOIN s)`` when
    ``b`` has one row per key, so the two small per-key tables are joined
    first and the fact rows meet a single join: one shuffle of the facts (or
    none, if AQE broadcasts the per-key side), and AQE's skew-join splitting
    applies to it, which it cannot for the second join of a chain.
    """
    per_key = budget_by_key.join(keys_present(select_schedule(schedule)), KEY, "full")
    return (
        actuals.join(per_key, KEY, "left")
        .select(*KEY, "INVOICE_DATE", "ACTUALS_COST", "BUDGET_CURRENT_APPROVED",
                "CURRENTSTART", "CURRENTEND")
    )


def schedule_for_actuals(schedule: DataFrame) -> DataFrame:
    """Per key: number of schedule rows and the first non-null start and end.

    Order of "first" (undefined at the source) is fixed as
    (CURRENTSTART, CURRENTEND) with nulls last, so the first non-null start
    is the minimum and the first non-null end is the end of the earliest
    row that has one. All three are partial-aggregatable.
    """
    s = keys_present(select_schedule(schedule))
    end_order = F.when(
        F.col("CURRENTEND").isNotNull(),
        F.struct(F.col("CURRENTSTART").isNull(), F.col("CURRENTSTART"), F.col("CURRENTEND")))
    return s.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("SCHEDULE_ROWS"),
        F.min("CURRENTSTART").alias("CURRENTSTART"),
        F.min_by("CURRENTEND", end_order).alias("CURRENTEND"),
    )


def daily_costs(actuals: DataFrame, zeros: bool = False) -> DataFrame:
    """A2 + P4: source cost per key and invoice date; zero sums removed unless ``zeros``, null keys and dates dropped."""
    rows = (
        actuals.select(*KEY, to_timestamp_strict(actuals, "INVOICE_DATE").alias("INVOICE_DATE"),
                       cost_amounts(actuals).alias("ACTUALS_COST"))
        .transform(lambda df: keys_present(df, ["INVOICE_DATE"]))
        .groupBy(*KEY, "INVOICE_DATE").agg(F.sum("ACTUALS_COST").alias("ACTUALS_COST"))
    )
    return rows if zeros else rows.filter(F.col("ACTUALS_COST") != 0)


def _per_key(budget_by_key: DataFrame, schedule: DataFrame) -> DataFrame:
    return budget_by_key.join(schedule_for_actuals(schedule), KEY, "full")


def _times(cost: Column, rows: Column, kind: T.DecimalType) -> Column:
    """``cost`` once per schedule row of its key, at the cost's scale (27 + 10 + 1 = 38 digits)."""
    n = F.coalesce(rows, F.lit(1)).cast("decimal(10,0)")
    return (cost.cast(T.DecimalType(27, min(kind.scale, 26))) * n).cast(kind)


def net_actuals(actuals: DataFrame, budget_by_key: DataFrame, schedule: DataFrame) -> DataFrame:
    """A2 + P4: net cost per key and invoice date; zero nets removed.

    Equal to grouping the joined rows: every cost row of a key is repeated
    once per schedule row of that key, so the date's sum is the source sum
    times the schedule row count.
    """
    costs = daily_costs(actuals)
    kind = costs.schema["ACTUALS_COST"].dataType
    return costs.join(_per_key(budget_by_key, schedule), KEY, "left").select(
        *KEY, "INVOICE_DATE", _times(F.col("ACTUALS_COST"), F.col("SCHEDULE_ROWS"), kind).alias("ACTUALS_COST"),
        "BUDGET_CURRENT_APPROVED", "CURRENTSTART", "CURRENTEND")


def actual_value(cost_sources: list[DataFrame], budget: DataFrame, schedule: DataFrame) -> DataFrame:
    """The ACTUALVALUE curve: net cost per key and date with its running total.

    The running total has two levels. Rows are dealt by (key, block of days) and accumulated inside it; one window
    per key over the blocks' totals gives what came before each block. The (key, date) rows meet their block, with
    the key's budget and schedule on it, where they lie: they are shuffled once after their sums, and no task holds the rows
    of a whole key.
    """
    costs = by_days(daily_costs(union_cost_sources(*cost_sources)))
    kind = costs.schema["ACTUALS_COST"].dataType
    totals = _blocks(costs).select(*KEY, "_DAYS", "_BEFORE").join(_per_key(budget_rollup(budget), schedule), KEY, "left")
    inside = Window.partitionBy(*KEY, "_DAYS").orderBy("INVOICE_DATE").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = F.col("SCHEDULE_ROWS")
    costs = costs.withColumn("_INSIDE", F.sum("ACTUALS_COST").over(inside))
    running = (F.col("_INSIDE") + F.col("_BEFORE")).cast(kind)
    return costs.join(totals, [*KEY, "_DAYS"]).withColumns({
        "CUMULATIVE_ACTUAL_COST": _times(running, rows, kind),
        "ACTUALS_COST": _times(F.col("ACTUALS_COST"), rows, kind),
    }).select(*ACTUAL_COLUMNS)


def _blocks(costs: DataFrame) -> DataFrame:
    """One row a key and block of days of ``by_days``: ``_TOTAL``, the last date ``_LAST`` and ``_BEFORE``, what earlier blocks have.

    The last date is read, so that totals and rows read the same columns and share the shuffle.
    """
    dated = costs.withColumnRenamed("INVOICE_DATE", "_DATE")
    totals = dated.groupBy(*KEY, "_DAYS").agg(F.sum("ACTUALS_COST").alias("_TOTAL"), F.max("_DATE").alias("_LAST")).filter(
        F.col("_LAST").isNotNull())
    earlier = Window.partitionBy(*KEY).orderBy("_LAST").rowsBetween(Window.unboundedPreceding, -1)
    kind = costs.schema["ACTUALS_COST"].dataType
    return totals.withColumn("_BEFORE", F.coalesce(F.sum("_TOTAL").over(earlier), F.lit(0)).cast(kind))


def position_of_costs(cost_sources: list[DataFrame], budget: DataFrame, schedule: DataFrame) -> DataFrame:
    """``actual_position`` of the ``actual_value`` of these inputs, from its blocks: no row of the curve is made.

    A key's total is its running cost on its last date. The plan up to the blocks is that of ``actual_value``, so a query
    that needs both reads, sums and deals the costs once.
    """
    costs = by_days(daily_costs(union_cost_sources(*cost_sources)))
    kind = costs.schema["ACTUALS_COST"].dataType
    to_date = (F.col("_BEFORE") + F.col("_TOTAL")).cast(kind)
    last = _blocks(costs).groupBy(*KEY).agg(F.max_by(F.struct(F.col("_LAST"), to_date.alias("_COST")), F.col("_DAYS")).alias("_ROW"))
    cost = _times(F.col("_ROW._COST"), F.col("SCHEDULE_ROWS"), kind)
    return last.join(_per_key(budget_rollup(budget), schedule), KEY, "left").select(
        *KEY, cost.alias("TOTAL_ACTUAL_COST"), "BUDGET_CURRENT_APPROVED", F.col("_ROW._LAST").alias("INVOICE_DATE"),
        cost.alias("CUMULATIVE_ACTUAL_COST"))


def by_days(costs: DataFrame) -> DataFrame:
    """Costs (K, INVOICE_DATE, ...) dealt by key and ``_DAYS``, the number of their block of days.

    A join by these infers that they are not null and pushes it to one of its sides only; stated here, both sides read
    the same plan, and the costs are read, summed and dealt once.
    """
    costs = costs.withColumn("_DAYS", F.floor(F.datediff(F.col("INVOICE_DATE").cast("date"), F.lit("1970-01-01").cast("date")) / DAYS))
    return costs.filter(F.col("_DAYS").isNotNull()).repartition(*KEY, "_DAYS")


def curve_rows(costs: DataFrame, budget_by_key: DataFrame, schedule: DataFrame) -> DataFrame:
    """The curve of source costs (K, INVOICE_DATE, ACTUALS_COST, CUMULATIVE_ACTUAL_COST): with budget and schedule, and costs
    repeated once per schedule row. They reach the rows by (key, block of days), as in ``actual_value``."""
    costs = by_days(costs)
    # All columns are read, so that the blocks and the rows come from one shuffle.
    read = F.max(F.struct("INVOICE_DATE", "ACTUALS_COST", "CUMULATIVE_ACTUAL_COST"))
    days = costs.groupBy(*KEY, "_DAYS").agg(read.alias("_LAST")).filter(F.col("_LAST").isNotNull()).drop("_LAST")
    days = days.join(_per_key(budget_by_key, schedule), KEY, "left")
    rows = F.col("SCHEDULE_ROWS")
    return costs.join(days, [*KEY, "_DAYS"]).withColumns({
        c: _times(F.col(c), rows, costs.schema[c].dataType) for c in ("ACTUALS_COST", "CUMULATIVE_ACTUAL_COST")})
