"""Planned cost curve: schedule x normalized curve x budget.

Day ``i`` of a ``d``-day schedule gets the curve value at percent
``round(i / d, 2)``; rows are then deduplicated to the first day of each
curve value. Only the first day of each percent key can survive that
dedup, so the default plan (``method="bucket"``) generates at most 101
candidate days per key directly, instead of one row per schedule day
(``method="daily"``, kept as the readable per-day form).

The curve is reduced to one row per sub-stage that holds its 101 points. The
first days of its values, and their running sums, depend on the sub-stage and
the number of days alone: they are found once for each such pair, as one array,
and meet the one-row-per-key inputs as that array. Only then are rows made, and
nothing after that shuffles or sorts them. Curve values keep their source type: they
are only copied and compared, and a decimal value's product with the budget is
exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import add_days, duration_days
from ..functions.percent import (
    MAX_PERCENT_KEY,
    curve_percent_key,
    leading_code,
    percent_first_days,
    schedule_percent_key,
)
from ..schema import KEY, PLANNED_COLUMNS
from ..sources.tables import select_norm_curve, select_schedule
from .actuals import budget_rollup, keys_present


def norm_curve_points(curve: DataFrame) -> DataFrame:
    """S4 + P11 + P12: curve points with the sub-stage code and the rounded percent."""
    c = select_norm_curve(curve)
    key = curve_percent_key(F.col("PERCENT_COMPLETIONTIME"))
    return c.select(
        leading_code(F.col("SUBSTAGES")).alias("SUB_STAGE"),
        key.alias("PCT_KEY"),
        (key / F.lit(100)).cast("double").alias("PERCENT_COMPLETIONTIME"),
        F.col("PERCENT_COMPLETIONTIME").cast("double").alias("RAW_PERCENT"),
        _curve_value(c).alias("NORM_PERCENT_CUMSPENT"),
    )


def _curve_value(curve: DataFrame) -> Column:
    """The curve value in its source type; text is read as double."""
    value = F.col("NORM_PERCENT_CUMSPENT")
    if isinstance(curve.schema["NORM_PERCENT_CUMSPENT"].dataType, T.DecimalType):
        return value
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def curve_lookup(curve: DataFrame) -> DataFrame:
    """One row per SUB_STAGE: ``POINTS[k]`` is the value of percent key k = 0..100.

    The value of a key is that of its first point in (unrounded percent, value)
    order, nulls last: 0 where the curve has no such point, NULL where the
    point's value is.
    """
    pts = norm_curve_points(curve).filter(
        F.col("SUB_STAGE").isNotNull() & F.col("PCT_KEY").between(0, MAX_PERCENT_KEY))
    order = F.struct(F.col("RAW_PERCENT"), F.col("NORM_PERCENT_CUMSPENT").isNull(),
                     F.col("NORM_PERCENT_CUMSPENT"))
    firsts = pts.groupBy("SUB_STAGE", "PCT_KEY").agg(
        F.min_by("NORM_PERCENT_CUMSPENT", order).alias("VALUE"))
    by_stage = firsts.groupBy("SUB_STAGE").agg(
        F.map_from_entries(F.collect_list(F.struct("PCT_KEY", "VALUE"))).alias("FOUND"))
    zero = F.lit(0).cast(firsts.schema["VALUE"].dataType)
    return by_stage.select("SUB_STAGE", F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(MAX_PERCENT_KEY).cast("long")),
        lambda k: F.when(F.map_contains_key("FOUND", k), F.try_element_at("FOUND", k)).otherwise(zero)).alias("POINTS"))


def first_schedule(schedule: DataFrame) -> DataFrame:
    """The first schedule row of each key in (CURRENTSTART, CURRENTEND) order, nulls last; null keys drop.

    Null keys meet no budget. Dropped here, the plan of ``planned_inputs`` and that of the durations are one, and the
    schedule is read and summed once.
    """
    s = keys_present(select_schedule(schedule))
    first_row = F.min_by(
        F.struct("CURRENTSTART", "CURRENTEND"),
        F.struct(F.col("CURRENTSTART").isNull(), F.col("CURRENTSTART"),
                 F.col("CURRENTEND").isNull(), F.col("CURRENTEND")))
    return s.groupBy(*KEY).agg(first_row.alias("row")).select(
        *KEY, F.col("row.CURRENTSTART").alias("CURRENTSTART"), F.col("row.CURRENTEND").alias("CURRENTEND"))


def planned_inputs(budget: DataFrame, schedule: DataFrame) -> DataFrame:
    """J3 + A3: budget (summed over funds, NULL -> 0) inner-joined to the schedule,
    one row per key: the first schedule row in (CURRENTSTART, CURRENTEND) order,
    nulls last. Both sides are per-key aggregates, so they arrive co-partitioned.
    """
    b = budget_rollup(budget)
    kind = b.schema["BUDGET_CURRENT_APPROVED"].dataType
    b = b.select(*KEY, F.coalesce(F.col("BUDGET_CURRENT_APPROVED"), F.lit(0).cast(kind)).alias("BUDGET_CURRENT_APPROVED"))
    return b.join(first_schedule(schedule), KEY, "inner").select(
        *KEY, "BUDGET_CURRENT_APPROVED", "CURRENTSTART", "CURRENTEND")


def _plannable(budget: DataFrame, schedule: DataFrame) -> DataFrame:
    """P6 + P14: keep start < end (nulls drop), with the inclusive day count."""
    return planned_inputs(budget, schedule).transform(_with_duration)


def _with_duration(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("CURRENTSTART") < F.col("CURRENTEND")).withColumn(
        "DURATION", duration_days(F.col("CURRENTSTART"), F.col("CURRENTEND")))


def _all_days(duration: Column) -> Column:
    """array<(DAY, PCT_KEY)>: every schedule day."""
    return F.transform(F.sequence(F.lit(0).cast("long"), duration - 1), lambda i: F.struct(
        i.alias("DAY"), schedule_percent_key(i, duration).alias("PCT_KEY")))


#: The candidate days of a schedule by method, in day order.
_DAYS = {"daily": _all_days, "bucket": percent_first_days}


def _day_curves(schedule: DataFrame, curve: DataFrame, days: Callable[[Column], Column]) -> DataFrame:
    """J4 + P15: one row per (SUB_STAGE, DURATION) of the schedule, with ``DAYS``: array<(DAY, VALUE)>.

    The day of each value depends on these two alone, so it is found once for all keys that share them; values
    are 0 where the sub-stage has no curve.
    """
    lookup = curve_lookup(curve)
    value = lookup.schema["POINTS"].dataType.elementType
    none = F.array_repeat(F.lit(0).cast(value), MAX_PERCENT_KEY + 1)
    pairs = first_schedule(schedule).transform(_with_duration).select("SUB_STAGE", "DURATION").distinct()
    rows = pairs.join(lookup, "SUB_STAGE", "left").withColumn("POINTS", F.coalesce("POINTS", none))
    return rows.select("SUB_STAGE", "DURATION", F.transform(days(F.col("DURATION")), lambda x: F.struct(
        x["DAY"].alias("DAY"), F.get("POINTS", x["PCT_KEY"].cast("int")).alias("VALUE"))).alias("DAYS"))


def _budget_type(kind: T.DecimalType) -> T.DecimalType:
    return T.DecimalType(min(28, 37 - kind.precision), 4)


def planned_amount(value: Column, kind: T.DataType, budget: Column) -> Column:
    """Value x budget; exact for a decimal curve (p + (37 - p) + 1 = 38 digits), else in double."""
    if is_exact(kind):
        return value * budget.cast(_budget_type(kind))
    return value.cast("double") * budget.cast("double")


def is_exact(kind: T.DataType) -> bool:
    """Whether planned values of a curve of this type are exact decimals, so that their order of addition does not matter."""
    return isinstance(kind, T.DecimalType) and kind.precision <= 25


def _valued(budget: DataFrame, schedule: DataFrame, curve: DataFrame, days: Callable[[Column], Column]) -> DataFrame:
    """P15 + P16: one row per candidate day, with its curve value and planned value."""
    rows = _plannable(budget, schedule).join(_day_curves(schedule, curve, days), ["SUB_STAGE", "DURATION"])
    return rows.select(*KEY, "BUDGET_CURRENT_APPROVED", "CURRENTSTART", F.inline("DAYS")).select(
        *KEY, add_days(F.col("CURRENTSTART"), F.col("DAY")).alias("DATE"), F.col("VALUE").alias("NORMALIZED_PERCENT"),
        planned_amount(F.col("VALUE"), rows.schema["DAYS"].dataType.elementType["VALUE"].dataType,
                        F.col("BUDGET_CURRENT_APPROVED")).alias("PLANNED_CURVE_VALUE"))


def planned_daily(budget: DataFrame, schedule: DataFrame, curve: DataFrame) -> DataFrame:
    """One row per schedule day with its curve value and planned value."""
    return _valued(budget, schedule, curve, _all_days)


def dedup_and_accumulate(daily: DataFrame) -> DataFrame:
    """A4 + W2: first day of each (key, curve value), NULL values dropped;
    then the running sum of the planned value in date order.

    Equal curve values merge into their earliest date even when not
    consecutive. The group key (key, value) is clustered by the key, so the
    aggregate and the window reuse one partitioning.
    """
    firsts = (
        daily.filter(F.col("NORMALIZED_PERCENT").isNotNull())
        .groupBy(*KEY, "NORMALIZED_PERCENT")
        .agg(F.min("DATE").alias("DATE"),
             F.min_by("PLANNED_CURVE_VALUE", F.col("DATE")).alias("PLANNED_CURVE_VALUE"))
    )
    w = (Window.partitionBy(*KEY).orderBy("DATE")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return firsts.withColumn(
        "CUMULATIVE_PLANNED_CURVE", F.sum("PLANNED_CURVE_VALUE").over(w)
    ).select(*PLANNED_COLUMNS)


def planned_by_key(budget: DataFrame, schedule: DataFrame, curve: DataFrame, method: str = "bucket",
                   per_key: DataFrame | None = None) -> DataFrame:
    """The planned curve of exact values, one row per key: KEY, BUDGET_CURRENT_APPROVED, CURRENTSTART and ``CURVE``, an
    array<(DAY, VALUE, TO_DATE)> of the first day of each value, with the sum of the values so far.

    A4 and W2 are done per (SUB_STAGE, DURATION): of equal values the first day stays, and a key's running total is its
    budget times the sum of the values, exactly. Curve rows are neither shuffled nor sorted. ``per_key`` (one row a
    key) is joined to the inputs, before they have a curve; keys that it lacks drop.
    """
    to_date = _sum_type(curve_kind(curve))
    firsts = _day_curves(schedule, curve, _DAYS[method]).select(
        "SUB_STAGE", "DURATION", F.inline("DAYS")).filter(F.col("VALUE").isNotNull()).groupBy(
            "SUB_STAGE", "DURATION", "VALUE").agg(F.min("DAY").alias("DAY"))
    w = (Window.partitionBy("SUB_STAGE", "DURATION").orderBy("DAY")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    firsts = firsts.withColumn("TO_DATE", F.sum("VALUE").over(w).cast(to_date))
    curves = firsts.groupBy("SUB_STAGE", "DURATION").agg(
        F.array_sort(F.collect_list(F.struct("DAY", "VALUE", "TO_DATE"))).alias("CURVE"))
    rows = _plannable(budget, schedule)
    if per_key is not None:
        rows = rows.join(per_key, KEY, "inner")
    return rows.join(curves, ["SUB_STAGE", "DURATION"]).select(
        *KEY, "BUDGET_CURRENT_APPROVED", "CURRENTSTART", "CURVE", *[c for c in ([] if per_key is None else per_key.columns) if c not in KEY])


def _sum_type(kind: T.DecimalType) -> T.DecimalType:
    """Holds the sum of a curve's values, 101 at most."""
    return T.DecimalType(kind.precision + 3, kind.scale)


def money_parts(budget: Column, kind: T.DecimalType) -> list[Column]:
    """``_MONEY``: the budget as planned values take it; ``_WHOLE`` and ``_FRACTION``: its two parts. One row a key has them."""
    money = budget.cast(_budget_type(kind))
    fraction = (money % F.lit(1)).cast(T.DecimalType(4, 4))
    whole = (money - fraction).cast(T.DecimalType(_budget_type(kind).precision - 4, 0))
    return [money.alias("_MONEY"), whole.alias("_WHOLE"), fraction.alias("_FRACTION")]


def amount_to_date(to_date: Column, kind: T.DecimalType) -> Column:
    """A sum of curve values (``_sum_type``) x budget, in the type that a sum of planned values has, exactly.

    The product of the two whole would lose places to the 38 digits of its type; those with ``money_parts`` have room.
    """
    exact = T.DecimalType(37, kind.scale + 4)
    total = T.DecimalType(min(38, kind.precision + _budget_type(kind).precision + 1 + 10), kind.scale + 4)
    return ((to_date * F.col("_WHOLE")).cast(exact) + (to_date * F.col("_FRACTION")).cast(exact)).cast(total)


def planned_rows(by_key: DataFrame) -> DataFrame:
    """The rows of ``planned_by_key``; other columns of a key follow."""
    kind = by_key.schema["CURVE"].dataType.elementType["VALUE"].dataType
    extra = [c for c in by_key.columns if c not in [*KEY, "BUDGET_CURRENT_APPROVED", "CURRENTSTART", "CURVE"]]
    rows = by_key.select(*KEY, "CURRENTSTART", *extra, *money_parts(F.col("BUDGET_CURRENT_APPROVED"), kind), "CURVE")
    return rows.select(*KEY, "CURRENTSTART", *extra, "_MONEY", "_WHOLE", "_FRACTION", F.inline("CURVE")).select(
        *KEY, F.col("VALUE").alias("NORMALIZED_PERCENT"), add_days(F.col("CURRENTSTART"), F.col("DAY")).alias("DATE"),
        planned_amount(F.col("VALUE"), kind, F.col("_MONEY")).alias("PLANNED_CURVE_VALUE"),
        amount_to_date(F.col("TO_DATE"), kind).alias("CUMULATIVE_PLANNED_CURVE"), *extra)


def curve_kind(curve: DataFrame) -> T.DataType:
    """The type of the curve's values."""
    return curve_lookup(curve).schema["POINTS"].dataType.elementType


def planned_value(budget: DataFrame, schedule: DataFrame, curve: DataFrame,
                  method: str = "bucket", deal: int | None = None) -> DataFrame:
    """The PLANNEDVALUE curve. ``deal``: keys are dealt to so many partitions before an exact curve's rows are made."""
    if method not in _DAYS:
        raise ValueError(f"unknown method {method!r}")
    if is_exact(curve_kind(curve)):
        by_key = planned_by_key(budget, schedule, curve, method)
        return planned_rows(by_key if deal is None else by_key.repartition(deal, *KEY)).select(*PLANNED_COLUMNS)
    # Sums of doubles depend on each planned value and on their order.
    return dedup_and_accumulate(_valued(budget, schedule, curve, _DAYS[method]))
