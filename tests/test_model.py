"""Random small inputs: Spark stages vs the row-at-a-time model in tests/model.py."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from costcurves.operators.actuals import actual_value
from costcurves.operators.forecast import forecast_value
from costcurves.operators.planned import planned_value
from costcurves.schema import (
    ACTUAL_COLUMNS,
    BUDGET_SOURCE,
    COST_SOURCE,
    CURVE_SOURCE,
    FORECAST_COLUMNS,
    PLANNED_COLUMNS,
    SCHEDULE_SOURCE,
)

from . import model

BASE = dt.datetime(2020, 1, 1)
PROJECTS, STAGES, SUBS = ["1", "2"], ["A"], ["X", "Y"]

key = st.tuples(st.sampled_from(PROJECTS), st.sampled_from(STAGES), st.sampled_from(SUBS))
maybe_key = st.tuples(st.sampled_from(PROJECTS * 3 + [None]), st.sampled_from(STAGES + [None]),
                      st.sampled_from(SUBS))
moment = st.builds(lambda d, h: BASE + dt.timedelta(days=d, hours=h),
                   st.integers(-20, 60), st.sampled_from([0, 0, 0, 8, 18]))
cents = st.integers(-3000, 3000).map(lambda c: Decimal(c) / 100)

cost_row = st.builds(lambda k, d, c: (*k, d, c), maybe_key, moment, st.one_of(st.none(), cents))
budget_row = st.builds(lambda k, v: (*k, v), key,
                       st.one_of(st.none(), st.integers(0, 10**8).map(lambda v: Decimal(v) / 10**4)))
schedule_row = st.builds(
    lambda k, s, n, h, null_end: (*k, s, None if null_end else s + dt.timedelta(days=n, hours=h)),
    key, moment, st.integers(-3, 260), st.sampled_from([0, 0, -12, 6]), st.sampled_from([False] * 5 + [True]))
curve_point = st.builds(
    lambda code, k, jitter, v: (code, (k + jitter) / 100, v),
    st.sampled_from(["X - a", "Y - b", "x - none", "X"]), st.integers(0, 100),
    st.sampled_from([0.0, 0.0, 0.0, 0.4, -0.4, 0.5]),
    st.one_of(st.none(), st.integers(0, 10**6).map(lambda v: Decimal(v) / 10**6)))


def _rows(df, cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def _model_rows(rows, cols):
    return Counter(tuple(r[c] for c in cols) for r in rows)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    sources=st.lists(cost_row, min_size=3, max_size=40),
    offsets=st.lists(st.builds(lambda k, d, c: (k, d, c), key, moment, cents), max_size=4),
    budgets=st.lists(budget_row, min_size=2, max_size=8),
    schedules=st.lists(schedule_row, min_size=1, max_size=8),
    curve=st.lists(curve_point, min_size=5, max_size=120),
    as_of_days=st.integers(0, 70),
)
def test_spark_matches_row_model(spark, sources, offsets, budgets, schedules, curve, as_of_days):
    # offsetting pairs exercise the zero-sum removal
    for k, d, c in offsets:
        sources += [(*k, d, c), (*k, d, -c)]
    src = spark.createDataFrame(sources, COST_SOURCE)
    bud = spark.createDataFrame(budgets, BUDGET_SOURCE)
    sch = spark.createDataFrame(schedules, SCHEDULE_SOURCE)
    cur = spark.createDataFrame(curve, CURVE_SOURCE)
    as_of = (BASE + dt.timedelta(days=as_of_days)).date()

    src_d = [dict(zip(["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "INVOICE_DATE", "ACTUALS_COST"], r))
             for r in sources]
    bud_d = [dict(zip(["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "BUDGET_CURRENT_APPROVED"], r)) for r in budgets]
    sch_d = [dict(zip(["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "CURRENTSTART", "CURRENTEND"], r))
             for r in schedules]
    cur_d = [dict(zip(["SUBSTAGES", "PERCENT_COMPLETIONTIME", "NORM_PERCENT_CUMSPENT"], r)) for r in curve]

    m_actual = model.actual_value(src_d, bud_d, sch_d)
    m_planned = model.planned_value(bud_d, sch_d, cur_d)
    m_forecast = model.forecast_value(m_planned, m_actual, as_of)

    s_actual = actual_value([src], bud, sch)
    s_planned = planned_value(bud, sch, cur)
    assert _rows(s_actual, ACTUAL_COLUMNS) == _model_rows(m_actual, ACTUAL_COLUMNS)
    assert _rows(s_planned, PLANNED_COLUMNS) == _model_rows(m_planned, PLANNED_COLUMNS)
    s_forecast = forecast_value(s_planned, s_actual, as_of)
    assert _rows(s_forecast, FORECAST_COLUMNS) == _model_rows(m_forecast, FORECAST_COLUMNS)
