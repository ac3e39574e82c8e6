"""Quality checks on hand-made rows: the branches the derived tables never reach."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from costcurves.operators import quality as q
from costcurves.schema import BUDGET_SOURCE, COST_SOURCE

D = dt.datetime
ACTUAL = ("PROJECT_NUMBER string, STAGE string, SUB_STAGE string, INVOICE_DATE timestamp_ntz, "
          "ACTUALS_COST decimal(38,2), BUDGET_CURRENT_APPROVED decimal(28,4), "
          "CURRENTSTART timestamp_ntz, CURRENTEND timestamp_ntz, CUMULATIVE_ACTUAL_COST decimal(38,2)")
FORECAST = ("PROJECT_NUMBER string, STAGE string, SUB_STAGE string, FORECAST_DATE timestamp_ntz, "
            "FORECAST_VALUE double, FORECAST_FINAL_VALUE double")
PLANNED = ("PROJECT_NUMBER string, STAGE string, SUB_STAGE string, NORMALIZED_PERCENT decimal(9,6), "
           "DATE timestamp_ntz, PLANNED_CURVE_VALUE decimal(38,10), CUMULATIVE_PLANNED_CURVE decimal(38,10)")


def _actual(spark, rows):
    return spark.createDataFrame(rows, ACTUAL)


def _a(key, day, cost, cum, budget=None, start=None, end=None):
    return (*key, D(2020, 1, day), Decimal(cost), budget, start, end, Decimal(cum))


def test_monotone_violation_on_credit(spark):
    k = ("P", "S", "X")
    actual = _actual(spark, [_a(k, 1, "10", "10"), _a(k, 2, "-4", "6"), _a(k, 3, "5", "11")])
    rows = q.monotone_violations(actual).collect()
    assert [(r.INVOICE_DATE.day, r.PREVIOUS_CUMULATIVE, r.CUMULATIVE_ACTUAL_COST) for r in rows] == \
        [(2, Decimal("10.00"), Decimal("6.00"))]


def test_continuity_fails_when_forecast_does_not_start_after_actuals(spark):
    actual = _actual(spark, [_a(("P", "S", "X"), 5, "1", "1"), _a(("Q", "S", "X"), 5, "1", "1")])
    fc = spark.createDataFrame([("P", "S", "X", D(2020, 1, 5), 0.0, 1.0),
                                ("Q", "S", "X", D(2020, 1, 6), 0.0, 1.0)], FORECAST)
    got = {r.PROJECT_NUMBER: r.continuity_check for r in q.continuity_check(actual, fc).collect()}
    assert got == {"P": "FAIL", "Q": "PASS"}


def test_freshness_stale_and_empty(spark):
    src = spark.createDataFrame([("P", "S", "X", D(2020, 1, 1), Decimal("1"))], COST_SOURCE)
    empty = spark.createDataFrame([], COST_SOURCE)
    rows = {r.source: r for r in q.freshness(
        {"OLD": (src, "INVOICE_DATE"), "EMPTY": (empty, "INVOICE_DATE")},
        as_of=dt.date(2020, 1, 9)).collect()}
    assert (rows["OLD"].days_since, rows["OLD"].status) == (8, "STALE")
    assert (rows["EMPTY"].days_since, rows["EMPTY"].status) == (None, "STALE")
    fresh = q.freshness({"OLD": (src, "INVOICE_DATE")}, as_of=dt.date(2020, 1, 8)).collect()[0]
    assert (fresh.days_since, fresh.status) == (7, "FRESH")


def test_timeline_issues(spark):
    k = ("P", "S", "X")
    s, e = D(2020, 1, 3), D(2020, 1, 5)
    actual = _actual(spark, [_a(k, 2, "1", "1", None, s, e), _a(k, 4, "1", "2", None, s, e),
                             _a(k, 6, "1", "3", None, s, e), _a(("Q", "S", "X"), 6, "1", "1")])
    got = sorted((r.PROJECT_NUMBER, r.INVOICE_DATE.day, r.ISSUE) for r in q.timeline_check(actual).collect())
    assert got == [("P", 2, "BEFORE_START"), ("P", 6, "AFTER_END"), ("Q", 6, "NO_SCHEDULE")]


def test_control_totals_full_outer(spark):
    src = spark.createDataFrame([
        ("P", "S", "X", D(2020, 1, 1), Decimal("5.00")),
        ("R", "S", "X", D(2020, 1, 1), Decimal("2.00")),
        ("R", "S", "X", D(2020, 1, 1), Decimal("-2.00")),
    ], COST_SOURCE)
    actual = _actual(spark, [_a(("P", "S", "X"), 1, "10", "10"), _a(("Z", "S", "X"), 1, "3", "3")])
    got = {r.PROJECT_NUMBER: (r.SOURCE_TOTAL, r.CURVE_TOTAL, r.STATUS)
           for r in q.control_totals([src], actual).collect()}
    assert got == {"P": (Decimal("5.00"), Decimal("10.00"), "MISMATCH"),
                   "R": (Decimal("0.00"), Decimal("0.00"), "MATCH"),
                   "Z": (Decimal("0.00"), Decimal("3.00"), "MISMATCH")}


def test_missing_keys_scored_counts_pairs(spark):
    budget = spark.createDataFrame([("P", "S", "X", Decimal("1")), ("Q", "S", "X", None)], BUDGET_SOURCE)
    actual = _actual(spark, [_a(("P", "S", "X"), 1, "1", "1"), _a(("P", "S", "X"), 2, "1", "2")])
    planned = spark.createDataFrame([("Q", "S", "X", Decimal("0"), D(2020, 1, 1), Decimal("0"), Decimal("0"))],
                                    PLANNED)
    fc = spark.createDataFrame([], FORECAST)
    r = q.score([("m", q.missing_keys_scored(budget, actual, planned, fc))]).collect()[0]
    assert (r.checked, r.failed) == (6, 4)


def test_missing_keys_per_curve(spark):
    budget = spark.createDataFrame([("P", "S", "X", Decimal("1")), ("Q", "S", "X", None)], BUDGET_SOURCE)
    actual = _actual(spark, [_a(("P", "S", "X"), 1, "1", "1")])
    planned = spark.createDataFrame([("Q", "S", "X", Decimal("0"), D(2020, 1, 1), Decimal("0"), Decimal("0"))],
                                    PLANNED)
    fc = spark.createDataFrame([], FORECAST)
    got = sorted((r.PROJECT_NUMBER, r.MISSING_FROM) for r in q.missing_keys(budget, actual, planned, fc).collect())
    assert got == [("P", "FORECAST"), ("P", "PLANNED"), ("Q", "ACTUAL"), ("Q", "FORECAST")]


def test_score_pools_checks_and_handles_empty_population(spark):
    from pyspark.sql import functions as F

    pop = spark.range(1000)
    empty = spark.range(0)
    got = {r.check: r for r in q.score([("a", q.flagged(pop, F.col("id") == 7)),
                                        ("b", q.flagged(empty, F.lit(True)))]).collect()}
    assert (got["a"].checked, got["a"].failed, got["a"].pass_rate, got["a"].meets_target) == (1000, 1, 0.999, True)
    assert (got["b"].checked, got["b"].pass_rate, got["b"].meets_target) == (0, 1.0, True)
    assert (got["OVERALL"].checked, got["OVERALL"].failed) == (1000, 1)


def test_completeness_and_profiles(spark):
    k = ("P", "S", "X")
    actual = _actual(spark, [_a(k, 1, "1", "1"), _a(("Q", "S", "X"), 1, "1", "1")])
    planned = spark.createDataFrame([], PLANNED)
    fc = spark.createDataFrame([], FORECAST)
    got = {r.source: r.project_count for r in q.completeness_check(actual, planned, fc).collect()}
    assert got == {"ACTUAL": 2, "PLANNED": 0, "FORECAST": 0}
    src = spark.createDataFrame([("P", "S", "X", D(2020, 1, 2), Decimal("1")),
                                 ("P", "S", "Y", D(2020, 1, 1), Decimal("1"))], COST_SOURCE)
    prof = q.source_profile({"INVOICE": src}).collect()[0]
    assert (prof.record_count, prof.earliest_date.day, prof.latest_date.day, prof.unique_projects) == (2, 1, 2, 1)
    counts = {r.source: r.record_count for r in q.source_counts({"INVOICE": src, "EMPTY": planned}).collect()}
    assert counts == {"INVOICE": 2, "EMPTY": 0}
