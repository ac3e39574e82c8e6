
from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costcurves.functions.percent import schedule_percent_key
from costcurves.plans.jobs import build_curves
from costcurves.schema import KEY
from costcurves.sources.fixtures import AS_OF, fixture_inputs


@pytest.fixture(scope="module")
def curves(spark, sf_dir):
    return build_curves(fixture_inputs(spark, sf_dir), as_of=AS_OF)


def test_last_running_cost_is_total(curves):
    per_key = curves.actual.groupBy(*KEY).agg(
        F.sum("ACTUALS_COST").alias("total"),
        F.max_by("CUMULATIVE_ACTUAL_COST", "INVOICE_DATE").alias("last"))
    assert per_key.filter(F.col("total") != F.col("last")).count() == 0


def test_one_row_per_key_and_day(curves):
    for df, day in ((curves.actual, "INVOICE_DATE"), (curves.planned, "DATE"),
                    (curves.forecast, "FORECAST_DATE")):
        assert df.groupBy(*KEY, day).count().filter("count > 1").count() == 0


def test_at_most_101_planned_rows_per_key(curves):
    assert curves.planned.groupBy(*KEY).count().agg(F.max("count")).first()[0] <= 101


def test_planned_is_non_decreasing(curves):
    from pyspark.sql import Window

    w = Window.partitionBy(*KEY).orderBy("DATE")
    prev = F.lag("PLANNED_CURVE_VALUE").over(w)
    assert curves.planned.select(
        (F.col("PLANNED_CURVE_VALUE") < prev).alias("down")).filter("down").count() == 0


def test_forecast_lands_on_budget_or_spend(curves):
    """Last forecast = max(budget, spent) where the budget is known and future weight > 0."""
    a = curves.actual.groupBy(*KEY).agg(F.sum("ACTUALS_COST").alias("spent"),
                                        F.max("BUDGET_CURRENT_APPROVED").alias("budget"))
    fut = curves.planned.filter(F.col("DATE") > F.lit(str(AS_OF)).cast("timestamp_ntz")) \
        .groupBy(*KEY).agg(F.sum("PLANNED_CURVE_VALUE").alias("weight"))
    last = curves.forecast.groupBy(*KEY).agg(
        F.max_by("FORECAST_FINAL_VALUE", "FORECAST_DATE").alias("last"))
    j = last.join(a, KEY).join(fut, KEY).filter("budget IS NOT NULL AND weight > 0")
    assert j.count() > 0
    expected = F.greatest(F.col("budget").cast("decimal(38,4)"), F.col("spent").cast("decimal(38,4)"))
    bad = j.filter(F.abs(F.col("last") - expected.cast("double")) > 1e-6)
    assert bad.count() == 0


def test_forecast_never_falls(curves):
    from pyspark.sql import Window

    w = Window.partitionBy(*KEY).orderBy("FORECAST_DATE")
    prev = F.lag("FORECAST_FINAL_VALUE").over(w)
    steps = curves.forecast.select((F.col("FORECAST_FINAL_VALUE") < prev - 1e-6).alias("down"))
    assert steps.filter("down").count() == 0


def test_forecast_starts_after_as_of(curves):
    assert curves.forecast.filter(
        F.col("FORECAST_DATE") <= F.lit(str(AS_OF)).cast("timestamp_ntz")).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 200_000), st.integers(0, 10**9)), min_size=1, max_size=200))
def test_percent_key_random_long_schedules(spark, pairs):
    rows = [(d, x % d) for d, x in pairs]
    df = spark.createDataFrame(rows, "d long, i long")
    got = [r.k for r in df.select(schedule_percent_key(F.col("i"), F.col("d")).alias("k")).collect()]
    assert got == [int(round(round(i / d, 2) * 100)) for d, i in rows]
