"""Control totals at every level of the key, and episodes of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import AMOUNT, KEY
from .actuals import cost_amounts, union_cost_sources
from .temporal import blocked, running


def control_cube(cost_sources: list[DataFrame], actual: DataFrame) -> DataFrame:
    """D7 at all eight levels of project, stage and sub-stage: source total, curve total, their difference.

    ``LEVEL`` is the grouping id: its bits, from the project down, mark keys that are summed over. Both sides are
    stacked and summed per key first, so the cube copies one row a key and neither side is read twice.
    """
    src = union_cost_sources(*cost_sources)
    src = src.select(*KEY, cost_amounts(src).alias("_C")).dropna(subset=KEY).groupBy(*KEY).agg(F.sum("_C").alias("_C"))
    cur = actual.groupBy(*KEY).agg(F.sum("ACTUALS_COST").alias("_C"))
    zero = F.lit(0).cast(AMOUNT)
    amount = F.coalesce(F.col("_C").cast(AMOUNT), zero)
    sides = src.select(*KEY, amount.alias("S"), zero.alias("C")).unionByName(cur.select(*KEY, zero.alias("S"), amount.alias("C")))
    kind = T.DecimalType(38, AMOUNT.scale)
    rows = sides.cube(*KEY).agg(F.grouping_id().alias("LEVEL"), F.sum("S").cast(kind).alias("SOURCE_TOTAL"),
                                F.sum("C").cast(kind).alias("CURVE_TOTAL"))
    difference = F.col("CURVE_TOTAL") - F.col("SOURCE_TOTAL")
    return rows.select(*KEY, "LEVEL", "SOURCE_TOTAL", "CURVE_TOTAL", difference.cast(kind).alias("DIFFERENCE"),
                       F.when(difference == 0, F.lit("MATCH")).otherwise(F.lit("MISMATCH")).alias("STATUS"))


def episodes(rows: DataFrame, keys: list[str], time: str, bad: Column, measures: list[Column]) -> DataFrame:
    """Unbroken stretches of rows (one a key and time) on which ``bad`` holds: keys, first and last time, rows, measures.

    The rows between two good ones share the number of good ones before them, a running count in two levels, so a hot
    key's rows are never in one window.
    """
    counted = running(rows.withColumn("_GOOD", (~bad).cast("long")), keys, time, "_GOOD", "_EPISODE")
    return counted.filter("_GOOD = 0").groupBy(*keys, "_EPISODE").agg(
        F.min(time).alias("FIRST_DATE"), F.max(time).alias("LAST_DATE"), F.count("*").alias("DATES"), *measures).drop("_EPISODE")


def shortfall_episodes(actual: DataFrame) -> DataFrame:
    """The stretches of dates on which a key's running cost lies below what it had reached before.

    FIRST_DATE, LAST_DATE, DATES, the length in days, the greatest depth, and whether the curve has come back since.
    """
    value = "CUMULATIVE_ACTUAL_COST"
    # The curve is computed and dealt by (key, block) once. The last date is read with its value: the same columns, the same shuffle.
    curve = blocked(actual.select(*KEY, "INVOICE_DATE", value), KEY, "INVOICE_DATE")
    rows = running(curve, KEY, "INVOICE_DATE", value, "_PEAK", F.max)
    last = curve.groupBy(*KEY).agg(F.max(F.struct("INVOICE_DATE", value))["INVOICE_DATE"].alias("_LAST"))
    depth = (F.col("_PEAK") - F.col(value)).cast(actual.schema[value].dataType)
    found = episodes(rows, KEY, "INVOICE_DATE", F.col(value) < F.col("_PEAK"), [F.max(depth).alias("DEPTH")])
    length = F.datediff(F.col("LAST_DATE").cast("date"), F.col("FIRST_DATE").cast("date")) + 1
    return found.join(last, KEY).select(*KEY, "FIRST_DATE", "LAST_DATE", "DATES", length.cast("long").alias("DAYS"), "DEPTH",
                                        (F.col("LAST_DATE") < F.col("_LAST")).alias("RECOVERED"))


def timeline_episodes(actual: DataFrame, issue: Column) -> DataFrame:
    """Unbroken stretches of dates outside the key's schedule, whatever the issue; the kinds are listed."""
    rows = actual.select(*KEY, "INVOICE_DATE", issue.alias("_ISSUE"))
    return episodes(rows, KEY, "INVOICE_DATE", F.col("_ISSUE").isNotNull(),
                    [F.array_join(F.array_sort(F.collect_set("_ISSUE")), ",").alias("ISSUES")])
