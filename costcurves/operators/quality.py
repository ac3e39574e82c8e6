"""Data-quality checks over the sources and the three curves.

Each check returns a DataFrame of findings (or per-key / per-source
statuses) instead of asserting, so it can be written, joined and scored.
All of them are aggregates or joins on the key / project, planned with
partial aggregation; none collects rows to the driver.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_of_date
from ..schema import AMOUNT, KEY
from .actuals import budget_rollup, cost_amounts, union_cost_sources
from .forecast import actual_position

QUALITY_TARGET = 0.999          # pass rate the quality score is measured against
PLANNED_TOLERANCE = "0.01"      # |budget - final planned| tolerance
FORECAST_TOLERANCE = 0.01       # |final forecast - max(budget, spent)| tolerance
FRESHNESS_DAYS = 7              # weekly refresh
CURVES = ("ACTUAL", "PLANNED", "FORECAST")


def _union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _pass_fail(cond: Column) -> Column:
    return F.when(cond, F.lit("PASS")).otherwise(F.lit("FAIL"))


# ---- source checks (A7, A8) -------------------------------------------------

def source_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Row count of each source table (global partial counts, no row shuffle)."""
    return _union_all([
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("source"), "record_count")
        for name, df in sources.items()
    ])


def source_profile(cost_sources: dict[str, DataFrame]) -> DataFrame:
    """Rows, first and last invoice date and distinct projects per cost source."""
    stacked = _union_all([
        df.select(F.lit(name).alias("source"), "PROJECTID", "INVOICE_DATE")
        for name, df in cost_sources.items()
    ])
    return stacked.groupBy("source").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("INVOICE_DATE").alias("earliest_date"),
        F.max("INVOICE_DATE").alias("latest_date"),
        F.countDistinct("PROJECTID").alias("unique_projects"),
    )


# ---- curve checks (D1-D11) --------------------------------------------------

def completeness_check(actual: DataFrame, planned: DataFrame, forecast: DataFrame) -> DataFrame:
    """Distinct projects per curve."""
    parts = [("ACTUAL", actual), ("PLANNED", planned), ("FORECAST", forecast)]
    return _union_all([
        df.agg(F.countDistinct("PROJECT_NUMBER").alias("project_count")).select(
            F.lit(name).alias("source"), "project_count")
        for name, df in parts
    ])


def continuity_check(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Per project, the forecast must start after the last actual date."""
    a = actual.groupBy("PROJECT_NUMBER").agg(F.max("INVOICE_DATE").alias("max_actual_date"))
    f = forecast.groupBy("PROJECT_NUMBER").agg(F.min("FORECAST_DATE").alias("min_forecast_date"))
    return a.join(f, "PROJECT_NUMBER", "inner").select(
        "PROJECT_NUMBER", "max_actual_date", "min_forecast_date",
        _pass_fail(F.col("min_forecast_date") > F.col("max_actual_date")).alias("continuity_check"))


def monotone_violations(actual: DataFrame) -> DataFrame:
    """Days where the running cost falls below the previous day's (credits).

    The previous running cost is the day's own less its cost, so a day violates
    when its cost is negative and it is not the key's first: no ordering of a
    key's rows, only a join of the credits with one date per key.
    """
    credits = actual.filter(F.col("ACTUALS_COST") < 0)
    firsts = actual.groupBy(*KEY).agg(F.min("INVOICE_DATE").alias("FIRST_DATE"))
    kind = actual.schema["CUMULATIVE_ACTUAL_COST"].dataType
    return credits.join(firsts, KEY).filter(F.col("INVOICE_DATE") > F.col("FIRST_DATE")).select(
        *KEY, "INVOICE_DATE",
        (F.col("CUMULATIVE_ACTUAL_COST") - F.col("ACTUALS_COST")).cast(kind).alias("PREVIOUS_CUMULATIVE"),
        "CUMULATIVE_ACTUAL_COST")


def planned_vs_budget(planned: DataFrame, budget: DataFrame) -> DataFrame:
    """The planned curve is cumulative, so its maximum should reach the budget."""
    b = budget_rollup(budget).select(
        *KEY, F.coalesce("BUDGET_CURRENT_APPROVED", F.lit(0)).alias("BUDGET_CURRENT_APPROVED"))
    p = planned.groupBy(*KEY).agg(F.max("PLANNED_CURVE_VALUE").alias("MAX_PLANNED"))
    kind = p.schema["MAX_PLANNED"].dataType
    exact = T.DecimalType(37, max(kind.scale, 4)) if isinstance(kind, T.DecimalType) else AMOUNT
    gap = F.col("BUDGET_CURRENT_APPROVED").cast(exact) - F.col("MAX_PLANNED").cast(exact)
    return p.join(b, KEY, "inner").select(
        *KEY, "MAX_PLANNED", "BUDGET_CURRENT_APPROVED", gap.alias("GAP"),
        _pass_fail(F.abs(gap) < F.lit(Decimal(PLANNED_TOLERANCE))).alias("STATUS"))


def _last_actual(actual: DataFrame, position: DataFrame | None = None) -> DataFrame:
    return (actual_position(actual) if position is None else position).select(
        *KEY, F.col("INVOICE_DATE").alias("LAST_ACTUAL_DATE"), F.col("CUMULATIVE_ACTUAL_COST").alias("LAST_ACTUAL"),
        "TOTAL_ACTUAL_COST", "BUDGET_CURRENT_APPROVED")


def forecast_continuity(actual: DataFrame, forecast: DataFrame, position: DataFrame | None = None) -> DataFrame:
    """D3: the first forecast point is not below the last running actual cost. ``position``: that of ``actual``, if known."""
    f = forecast.groupBy(*KEY).agg(
        F.min("FORECAST_DATE").alias("FIRST_FORECAST_DATE"),
        F.min_by("FORECAST_FINAL_VALUE", F.col("FORECAST_DATE")).alias("FIRST_FORECAST"))
    a = _last_actual(actual, position)
    return f.join(a, KEY, "inner").select(
        *KEY, "LAST_ACTUAL_DATE", "LAST_ACTUAL", "FIRST_FORECAST_DATE", "FIRST_FORECAST",
        _pass_fail(F.col("FIRST_FORECAST") >= F.col("LAST_ACTUAL").cast("double")).alias("STATUS"))


def budget_alignment(actual: DataFrame, forecast: DataFrame, position: DataFrame | None = None) -> DataFrame:
    """The last forecast point lands on max(budget, spent). ``position``: that of ``actual``, if known."""
    f = forecast.groupBy(*KEY).agg(
        F.max("FORECAST_DATE").alias("LAST_FORECAST_DATE"),
        F.max_by("FORECAST_FINAL_VALUE", F.col("FORECAST_DATE")).alias("LAST_FORECAST"))
    a = _last_actual(actual, position)
    expected = F.when(F.col("BUDGET_CURRENT_APPROVED").isNotNull(),
                      F.greatest(F.col("BUDGET_CURRENT_APPROVED").cast(AMOUNT),
                                 F.col("TOTAL_ACTUAL_COST").cast(AMOUNT)))
    return f.join(a, KEY, "inner").select(
        *KEY, "LAST_FORECAST_DATE", "LAST_FORECAST",
        expected.cast("double").alias("EXPECTED_FINAL"),
        _pass_fail(F.abs(F.col("LAST_FORECAST") - expected.cast("double")) < FORECAST_TOLERANCE)
        .alias("STATUS"))


def _presence(budget: DataFrame, keys: list[str], curves: tuple[DataFrame, ...]) -> DataFrame:
    """The budgeted ``keys`` once each, with ``MISSING``: the curves that lack them.

    Curves and budget are stacked as distinct keys (map-side partial
    aggregation) and grouped once.
    """
    parts = [budget_rollup(budget).select(*keys).dropna().distinct().withColumn("_IN", F.lit("BUDGET"))]
    parts += [df.select(*keys).distinct().withColumn("_IN", F.lit(name)) for name, df in zip(CURVES, curves)]
    found = _union_all(parts).groupBy(*keys).agg(F.collect_set("_IN").alias("_SEEN"))
    return found.filter(F.array_contains("_SEEN", "BUDGET")).select(
        *keys, F.array_except(F.array(*[F.lit(c) for c in CURVES]), F.col("_SEEN")).alias("MISSING"))


def missing_keys(budget: DataFrame, actual: DataFrame, planned: DataFrame,
                 forecast: DataFrame) -> DataFrame:
    """Budgeted keys absent from a curve."""
    found = _presence(budget, KEY, (actual, planned, forecast))
    return found.select(*KEY, F.explode("MISSING").alias("MISSING_FROM"))


def control_totals(cost_sources: list[DataFrame], actual: DataFrame) -> DataFrame:
    """Per key, source cost total vs the actual curve's total (full outer join)."""
    src = union_cost_sources(*cost_sources)
    src_tot = src.select(*KEY, cost_amounts(src).alias("c")).dropna(subset=KEY).groupBy(*KEY).agg(
        F.sum("c").alias("SOURCE_TOTAL"))
    cur_tot = actual.groupBy(*KEY).agg(F.sum("ACTUALS_COST").alias("CURVE_TOTAL"))
    zero = F.lit(0).cast(AMOUNT)
    s = F.coalesce(F.col("SOURCE_TOTAL").cast(AMOUNT), zero)
    c = F.coalesce(F.col("CURVE_TOTAL").cast(AMOUNT), zero)
    return src_tot.join(cur_tot, KEY, "full").select(
        *KEY, s.alias("SOURCE_TOTAL"), c.alias("CURVE_TOTAL"), (c - s).alias("DIFFERENCE"),
        F.when(c == s, F.lit("MATCH")).otherwise(F.lit("MISMATCH")).alias("STATUS"))


def freshness(dated: dict[str, tuple[DataFrame, str]], as_of=None,
              max_age_days: int = FRESHNESS_DAYS) -> DataFrame:
    """Latest date of each table vs ``as_of``; stale beyond ``max_age_days``."""
    today = as_of_date(as_of)
    rows = _union_all([
        df.agg(F.max(col).alias("latest_date")).select(F.lit(name).alias("source"), "latest_date")
        for name, (df, col) in dated.items()
    ])
    age = F.datediff(today, F.col("latest_date").cast("date"))
    return rows.select(
        "source", "latest_date", age.cast("bigint").alias("days_since"),
        F.when(age.isNotNull() & (age <= max_age_days), F.lit("FRESH")).otherwise(F.lit("STALE"))
        .alias("status"))


def timeline_issue() -> Column:
    """What is wrong with a date of the actual curve; null inside its schedule."""
    d, s, e = F.col("INVOICE_DATE"), F.col("CURRENTSTART"), F.col("CURRENTEND")
    return (F.when(s.isNull() | e.isNull(), F.lit("NO_SCHEDULE"))
            .when(d < s, F.lit("BEFORE_START"))
            .when(d > e, F.lit("AFTER_END")))


def timeline_check(actual: DataFrame) -> DataFrame:
    """Actual days outside the key's schedule window."""
    return actual.select(*KEY, "INVOICE_DATE", "CURRENTSTART", "CURRENTEND",
                         timeline_issue().alias("ISSUE")).filter(F.col("ISSUE").isNotNull())


# ---- scoring (D9) -------------------------------------------------------------

def flagged(rows: DataFrame, failed: Column) -> DataFrame:
    """A check as scored rows: each row of ``rows`` is one item checked, failed
    when ``failed`` is true (NULL counts as passed)."""
    return rows.select(F.lit(1).cast("bigint").alias("checked"),
                       F.coalesce(failed, F.lit(False)).cast("bigint").alias("failed"))


def monotone_scored(actual: DataFrame) -> DataFrame:
    """D1 as scored rows: every actual day is an item, a credit after the key's first day a failure."""
    firsts = actual.groupBy(*KEY).agg(F.min("INVOICE_DATE").alias("FIRST_DATE"), F.count(F.lit(1)).alias("DAYS"))
    credits = actual.filter(F.col("ACTUALS_COST") < 0).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("CREDITS"), F.min("INVOICE_DATE").alias("FIRST_CREDIT"))
    opening = F.when(F.col("FIRST_CREDIT") == F.col("FIRST_DATE"), 1).otherwise(0)
    return firsts.join(credits, KEY, "left").select(
        F.col("DAYS").cast("bigint").alias("checked"),
        (F.coalesce("CREDITS", F.lit(0)) - opening).cast("bigint").alias("failed"))


def timeline_scored(actual: DataFrame) -> DataFrame:
    """D11 as scored rows: every actual day is checked against its schedule."""
    return flagged(actual, timeline_issue().isNotNull())


def missing_keys_scored(budget: DataFrame, actual: DataFrame, planned: DataFrame,
                        forecast: DataFrame) -> DataFrame:
    """D6 as scored rows: each budgeted key is checked once per curve (3 items)."""
    return _presence_scored(budget, KEY, (actual, planned, forecast))


def completeness_scored(budget: DataFrame, actual: DataFrame, planned: DataFrame,
                        forecast: DataFrame) -> DataFrame:
    """D4 as scored rows: each budgeted project is checked once per curve (3 items)."""
    return _presence_scored(budget, ["PROJECT_NUMBER"], (actual, planned, forecast))


def _presence_scored(budget: DataFrame, keys: list[str], curves: tuple[DataFrame, ...]) -> DataFrame:
    return _presence(budget, keys, curves).select(
        F.lit(len(CURVES)).cast("bigint").alias("checked"), F.size("MISSING").cast("bigint").alias("failed"))


def score(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Pass rate per check and overall, against the 99.9% target.

    Each check is a DataFrame of scored rows (``checked``, ``failed``) summed
    to one row (partial aggregation, no row shuffle); one rollup over the check
    names gives the overall row, which pools all checks. A check without rows
    has rate 1.
    """
    sums = _union_all([
        df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("checked", "failed")]).select(
            F.lit(name).alias("check"), "checked", "failed")
        for name, df in checks
    ])
    both = sums.rollup("check").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed")).withColumn(
        "check", F.coalesce("check", F.lit("OVERALL")))
    rate = F.when(F.col("checked") == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.col("failed").cast("double") / F.col("checked").cast("double"))
    return both.select("check", "checked", "failed", rate.alias("pass_rate"), (rate >= QUALITY_TARGET).alias("meets_target"))
