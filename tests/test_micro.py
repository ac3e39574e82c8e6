"""Hand-made rows for edge cases the supplied tables cannot produce (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from costcurves.operators.actuals import actual_value, budget_rollup, net_actuals, union_cost_sources
from costcurves.operators.combine import combined_curves
from costcurves.operators.forecast import forecast_value
from costcurves.operators.planned import planned_daily, planned_value
from costcurves.schema import BUDGET_SOURCE, COST_SOURCE, CURVE_SOURCE, SCHEDULE_SOURCE

D = dt.datetime
STR_COST = T.StructType([
    T.StructField("PROJECTID", T.StringType()),
    T.StructField("STAGEPHASE_CODE", T.StringType()),
    T.StructField("SUBSTAGEACTIVITY_CODE", T.StringType()),
    T.StructField("INVOICE_DATE", T.StringType()),
    T.StructField("ACTUALS_COST", T.StringType()),
])


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _budget(spark, rows=(("P", "S", "SS", Decimal("1000.0000")),)):
    return _df(spark, list(rows), BUDGET_SOURCE)


def _schedule(spark, rows):
    return _df(spark, list(rows), SCHEDULE_SOURCE)


def _curve(spark, rows):
    return _df(spark, list(rows), CURVE_SOURCE)


def _linear_curve(spark, code="SS"):
    return _curve(spark, [(f"{code} - x", k / 100, Decimal(k) / 100) for k in range(101)])


def test_null_keys_and_dates_dropped(spark):
    src = _df(spark, [
        ("P", "S", "SS", D(2020, 1, 1), Decimal("5.00")),
        (None, "S", "SS", D(2020, 1, 1), Decimal("5.00")),
        ("P", None, "SS", D(2020, 1, 1), Decimal("5.00")),
        ("P", "S", None, D(2020, 1, 1), Decimal("5.00")),
        ("P", "S", "SS", None, Decimal("5.00")),
    ], COST_SOURCE)
    out = actual_value([src], _budget(spark), _schedule(spark, [])).collect()
    assert len(out) == 1 and out[0].ACTUALS_COST == Decimal("5.00")


def test_bad_numbers_become_zero(spark):
    src = _df(spark, [
        ("P", "S", "SS", "2020-01-01", "abc"),
        ("P", "S", "SS", "2020-01-01", "1,000"),
        ("P", "S", "SS", "2020-01-01", "1d"),
        ("P", "S", "SS", "2020-01-01", None),
        ("P", "S", "SS", "2020-01-01", " 2.50 "),
        ("P", "S", "SS", "2020-01-02", "abc"),
    ], STR_COST)
    out = actual_value([src], _budget(spark), _schedule(spark, [])).collect()
    # the 2020-01-02 day nets to 0 and is removed
    assert [(r.INVOICE_DATE, r.ACTUALS_COST) for r in out] == [(D(2020, 1, 1), Decimal("2.50"))]


def test_malformed_date_raises(spark):
    src = _df(spark, [("P", "S", "SS", "not a date", "1")], STR_COST)
    with pytest.raises(Exception):
        actual_value([src], _budget(spark), _schedule(spark, [])).collect()


def test_offsetting_costs_removed_exactly(spark):
    src = _df(spark, [
        ("P", "S", "SS", D(2020, 1, 1), Decimal("0.10")),
        ("P", "S", "SS", D(2020, 1, 1), Decimal("0.20")),
        ("P", "S", "SS", D(2020, 1, 1), Decimal("-0.30")),
        ("P", "S", "SS", D(2020, 1, 2), Decimal("7.00")),
    ], COST_SOURCE)
    out = actual_value([src], _budget(spark), _schedule(spark, [])).collect()
    assert [(r.INVOICE_DATE.day, r.CUMULATIVE_ACTUAL_COST) for r in out] == [(2, Decimal("7.00"))]


def test_repeated_schedule_doubles_cost_and_first_row_wins(spark):
    src = _df(spark, [("P", "S", "SS", D(2020, 1, 5), Decimal("10.00"))], COST_SOURCE)
    sched = _schedule(spark, [
        ("P", "S", "SS", D(2020, 1, 3), D(2020, 3, 1)),
        ("P", "S", "SS", D(2020, 1, 1), None),
    ])
    r = actual_value([src], _budget(spark), sched).collect()[0]
    assert r.ACTUALS_COST == Decimal("20.00")
    assert r.CURRENTSTART == D(2020, 1, 1)      # first non-null start
    assert r.CURRENTEND == D(2020, 3, 1)        # first non-null end
    assert r.BUDGET_CURRENT_APPROVED == Decimal("1000.0000")


def test_budget_rolls_up_funds_and_null_stays_null(spark):
    b = _budget(spark, [("P", "S", "SS", Decimal("1.5000")), ("P", "S", "SS", Decimal("2.0000")),
                        ("Q", "S", "SS", None)])
    got = {r.PROJECT_NUMBER: r.BUDGET_CURRENT_APPROVED for r in budget_rollup(b).collect()}
    assert got == {"P": Decimal("3.5000"), "Q": None}


def test_duration_floors_and_keeps_time_of_day(spark):
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1, 18), D(2020, 1, 3, 6))])
    rows = planned_daily(_budget(spark), sched, _linear_curve(spark)).orderBy("DATE").collect()
    assert [r.DATE for r in rows] == [D(2020, 1, 1, 18), D(2020, 1, 2, 18)]
    assert [r.NORMALIZED_PERCENT for r in rows] == [Decimal("0.000000"), Decimal("0.500000")]


def test_same_day_schedule_is_one_row_at_zero(spark):
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1, 8), D(2020, 1, 1, 17))])
    rows = planned_daily(_budget(spark), sched, _linear_curve(spark)).collect()
    assert len(rows) == 1 and rows[0].NORMALIZED_PERCENT == Decimal("0.000000")


def test_start_not_before_end_or_null_is_skipped(spark):
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 5), D(2020, 1, 5)),
                              ("P", "S", "SS", D(2020, 1, 9), D(2020, 1, 5))])
    b = _budget(spark)
    assert planned_value(b, sched, _linear_curve(spark)).count() == 0
    sched2 = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), None)])
    assert planned_value(b, sched2, _linear_curve(spark)).count() == 0


def test_curve_duplicates_lowest_unrounded_percent_wins(spark):
    curve = _curve(spark, [("SS - a", 0.504, Decimal("0.700000")), ("SS - b", 0.496, Decimal("0.600000")),
                           ("SS - c", 0.0, Decimal("0.000000"))])
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 1, 2))])   # days 0, 1 -> 0, 50
    rows = planned_daily(_budget(spark), sched, curve).orderBy("DATE").collect()
    assert [r.NORMALIZED_PERCENT for r in rows] == [Decimal("0.000000"), Decimal("0.600000")]


def test_curve_without_leading_code_never_matches(spark):
    curve = _curve(spark, [("ss - lower", 0.0, Decimal("0.100000")), (" SS", 0.0, Decimal("0.100000"))])
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 1, 2))])
    rows = planned_daily(_budget(spark), sched, curve).collect()
    assert {r.NORMALIZED_PERCENT for r in rows} == {Decimal("0.000000")}


def test_missing_point_is_zero_null_point_is_dropped(spark):
    curve = _curve(spark, [("SS - x", 0.5, None)])
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 1, 2))])
    daily = planned_daily(_budget(spark), sched, curve).orderBy("DATE").collect()
    assert [r.NORMALIZED_PERCENT for r in daily] == [Decimal("0.000000"), None]
    pv = planned_value(_budget(spark), sched, curve).collect()
    assert len(pv) == 1 and pv[0].DATE == D(2020, 1, 1)


@pytest.mark.parametrize("days", [8, 40, 200, 201])
def test_bucket_jump_equals_day_explosion(spark, days):
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 1, 1) + dt.timedelta(days=days - 1))])
    b, c = _budget(spark), _linear_curve(spark)
    fast = sorted(tuple(r) for r in planned_value(b, sched, c, method="bucket").collect())
    slow = sorted(tuple(r) for r in planned_value(b, sched, c, method="daily").collect())
    assert fast == slow
    keys = {round(r[3] * 100) for r in fast}
    assert keys == {int(round(round(i / days, 2) * 100)) for i in range(days)}
    if days <= 200:
        assert max(keys) < 100     # the curve end is reached only beyond 200 days
    else:
        assert max(keys) == 100


def _forecast_inputs(spark, planned_rows, actual_rows):
    planned = spark.createDataFrame(planned_rows, (
        "PROJECT_NUMBER string, STAGE string, SUB_STAGE string, NORMALIZED_PERCENT decimal(9,6), "
        "DATE timestamp_ntz, PLANNED_CURVE_VALUE decimal(38,10), CUMULATIVE_PLANNED_CURVE decimal(38,10)"))
    actual = spark.createDataFrame(actual_rows, (
        "PROJECT_NUMBER string, STAGE string, SUB_STAGE string, INVOICE_DATE timestamp_ntz, "
        "ACTUALS_COST decimal(38,2), BUDGET_CURRENT_APPROVED decimal(28,4), CURRENTSTART timestamp_ntz, "
        "CURRENTEND timestamp_ntz, CUMULATIVE_ACTUAL_COST decimal(38,2)"))
    return planned, actual


def test_zero_future_weights_keep_forecast_flat(spark):
    z = Decimal(0)
    planned, actual = _forecast_inputs(
        spark,
        [("P", "S", "SS", z, D(2020, 2, d), z, z) for d in (1, 2, 3)],
        [("P", "S", "SS", D(2020, 1, 1), Decimal("40.00"), Decimal("100.0000"), None, None, Decimal("40.00"))])
    out = forecast_value(planned, actual, as_of=dt.date(2020, 1, 15)).collect()
    assert [r.FORECAST_FINAL_VALUE for r in out] == [40.0, 40.0, 40.0]
    assert [r.FORECAST_VALUE for r in out] == [0.0, 0.0, 0.0]


def test_forecast_reaches_budget_and_keeps_0800_today(spark):
    planned, actual = _forecast_inputs(
        spark,
        [("P", "S", "SS", Decimal("0.5"), D(2020, 1, 15, 8), Decimal("50"), Decimal("50")),
         ("P", "S", "SS", Decimal("0.5"), D(2020, 1, 14), Decimal("50"), Decimal("100")),
         ("P", "S", "SS", Decimal("1"), D(2020, 1, 20), Decimal("150"), Decimal("250"))],
        [("P", "S", "SS", D(2020, 1, 1), Decimal("40.00"), Decimal("100.0000"), None, None, Decimal("40.00"))])
    out = forecast_value(planned, actual, as_of=dt.date(2020, 1, 15)).orderBy("FORECAST_DATE").collect()
    assert [r.FORECAST_DATE for r in out] == [D(2020, 1, 15, 8), D(2020, 1, 20)]
    assert out[0].FORECAST_VALUE == pytest.approx(15.0)
    assert out[-1].FORECAST_FINAL_VALUE == pytest.approx(100.0)


def test_null_budget_gives_null_forecast_and_zero_in_combined(spark):
    planned, actual = _forecast_inputs(
        spark,
        [("P", "S", "SS", Decimal("0.5"), D(2020, 2, 1), Decimal("5"), Decimal("5"))],
        [("P", "S", "SS", D(2020, 1, 1), Decimal("40.00"), None, None, None, Decimal("40.00"))])
    fc = forecast_value(planned, actual, as_of=dt.date(2020, 1, 15))
    assert fc.collect()[0].FORECAST_FINAL_VALUE is None
    comb = combined_curves(actual, planned, fc).filter("TYPE = 'FORECAST'").collect()
    assert comb[0].VALUE == 0.0


def test_empty_inputs_give_empty_outputs_with_schema(spark):
    src = spark.createDataFrame([], COST_SOURCE)
    b = spark.createDataFrame([], BUDGET_SOURCE)
    s = spark.createDataFrame([], SCHEDULE_SOURCE)
    c = spark.createDataFrame([], CURVE_SOURCE)
    a = actual_value([src], b, s)
    p = planned_value(b, s, c)
    f = forecast_value(p, a, as_of=dt.date(2020, 1, 1))
    comb = combined_curves(a, p, f)
    for df in (a, p, f, comb):
        assert df.count() == 0
    assert comb.columns == ["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "DATE", "VALUE", "TYPE"]


def test_net_actuals_matches_row_level_grouping(spark, sf_dir):
    """The multiplier form equals grouping the fanned-out join rows."""
    from pyspark.sql import functions as F

    from costcurves.operators.actuals import enrich_actuals
    from costcurves.schema import KEY
    from costcurves.sources.fixtures import fixture_inputs

    i = fixture_inputs(spark, sf_dir)
    u = union_cost_sources(i.invoice, i.pay_app, i.pay_req)
    b = budget_rollup(i.budget)
    net = net_actuals(u, b, i.schedule).select(*KEY, "INVOICE_DATE", "ACTUALS_COST")
    rows = (enrich_actuals(u, b, i.schedule).dropna(subset=[*KEY, "INVOICE_DATE"]).groupBy(*KEY, "INVOICE_DATE")
            .agg(F.sum("ACTUALS_COST").cast("decimal(38,10)").alias("ACTUALS_COST"))
            .filter("ACTUALS_COST != 0"))
    assert net.exceptAll(rows).count() == 0 and rows.exceptAll(net).count() == 0


def test_results_do_not_depend_on_session_time_zone(spark, sf_dir):
    """timestamp_ntz arithmetic only: a zone with midnight DST gaps changes nothing."""
    from costcurves.plans.registry import queries

    names = ["actual_value", "planned_value", "forecast_value", "planned_daily"]
    base = {n: sorted(tuple(r) for r in queries()[n](spark, sf_dir).collect()) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        for n in names:
            assert sorted(tuple(r) for r in queries()[n](spark, sf_dir).collect()) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_recent_rows_window_is_calendar_years_inclusive(spark):
    from costcurves.sources.sinks import recent_rows

    src = spark.createDataFrame([
        ("P", "S", "X", D(2022, 2, 27, 23), Decimal("1")),
        ("P", "S", "X", D(2022, 2, 28), Decimal("1")),
        ("P", "S", "X", D(2024, 2, 29, 8), Decimal("1")),
    ], COST_SOURCE)
    got = [r.INVOICE_DATE for r in recent_rows(src, as_of=dt.date(2024, 2, 29)).orderBy("INVOICE_DATE").collect()]
    assert got == [D(2022, 2, 28), D(2024, 2, 29, 8)]


def test_running_total_of_timestamps(spark):
    """Several rows a day, over many days and a repeated schedule: equal to one ordered window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from costcurves.schema import KEY

    times = spark.createDataFrame(
        [("P", "S", "X", D(2020, 1, 1 + d // 24, d % 24), Decimal(d % 7 - 2)) for d in range(24 * 5)]
        + [("Q", "S", "X", D(2020, 1, 2), Decimal("1"))], COST_SOURCE)
    twice = _schedule(spark, [("P", "S", "X", D(2020, 1, 1), D(2020, 2, 1)), ("P", "S", "X", D(2020, 1, 3), None)])
    net = net_actuals(union_cost_sources(times), budget_rollup(_budget(spark)), twice)
    w = Window.partitionBy(*KEY).orderBy("INVOICE_DATE").rowsBetween(Window.unboundedPreceding, 0)
    want = net.withColumn("CUMULATIVE_ACTUAL_COST", F.sum("ACTUALS_COST").over(w).cast("decimal(38,2)"))
    got = actual_value([times], _budget(spark), twice)
    assert got.columns == want.columns
    a, b = (sorted(tuple(r) for r in df.collect()) for df in (want, got))
    assert a == b and len(a) > 24


def test_costs_keep_the_precision_of_their_source(spark):
    """Text and double costs below a cent are neither rounded nor dropped."""
    rows = [("P", "S", "X", D(2020, 1, 1), v) for v in ("10.126", "10.126")] + [("P", "S", "X", D(2020, 1, 2), "0.004")]
    text = spark.createDataFrame(rows, "PROJECTID string, STAGEPHASE_CODE string, SUBSTAGEACTIVITY_CODE string, "
                                       "INVOICE_DATE timestamp_ntz, ACTUALS_COST string")
    for src in (text, text.withColumn("ACTUALS_COST", text.ACTUALS_COST.cast("double"))):
        got = {r.INVOICE_DATE.day: float(r.ACTUALS_COST) for r in
               actual_value([src], _budget(spark), _schedule(spark, [])).collect()}
        assert got == {1: 20.252, 2: 0.004}


def test_fine_curve_values_stay_apart(spark):
    """101 distinct values, 60 of them below 2e-7: no row merges and the value is not cut."""
    values = [k * 3e-9 for k in range(60)] + [(k - 59) / 41 for k in range(60, 101)]
    curve = spark.createDataFrame([("SS - x", k / 100, v) for k, v in enumerate(values)],
                                  "SUBSTAGES string, PERCENT_COMPLETIONTIME double, NORM_PERCENT_CUMSPENT double")
    budget = spark.createDataFrame([("P", "S", "SS", Decimal("100000000"))], BUDGET_SOURCE)
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 12, 30))])
    rows = planned_value(budget, sched, curve).collect()
    assert len(rows) == 101
    assert {r.NORMALIZED_PERCENT: r.PLANNED_CURVE_VALUE for r in rows} == {v: v * 1e8 for v in values}
    daily = planned_value(budget, sched, curve, method="daily").collect()
    assert sorted(tuple(r) for r in daily) == sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz"])
def test_schedule_dates_of_any_type(spark, kind):
    typed = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 4, 9))])
    sched = typed.select(*[typed[c].cast(kind).alias(c) if c.startswith("CURRENT") else typed[c] for c in typed.columns])
    want, got = (planned_value(_budget(spark), s, _linear_curve(spark)) for s in (typed, sched))
    assert dict(got.dtypes)["DATE"] == "timestamp_ntz"
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_unreadable_schedule_date_raises(spark):
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 4, 9))])
    bad = sched.withColumn("CURRENTEND", sched.CURRENTEND.cast("string")).replace("2020-04-09 00:00:00", "soon")
    with pytest.raises(Exception, match="unreadable timestamp"):
        planned_value(_budget(spark), bad, _linear_curve(spark)).collect()


def test_decimal_percent_column_matches_double(spark):
    """The curve's completion percent may arrive as a decimal."""
    dec_schema = T.StructType([
        T.StructField("SUBSTAGES", T.StringType()),
        T.StructField("PERCENT_COMPLETIONTIME", T.DecimalType(5, 4)),
        T.StructField("NORM_PERCENT_CUMSPENT", T.DecimalType(9, 6)),
    ])
    rows = [("SS - x", k, Decimal(k * k) / 10000) for k in range(101)]
    as_double = _curve(spark, [(c, k / 100, v) for c, k, v in rows])
    as_decimal = spark.createDataFrame([(c, Decimal(k) / 100, v) for c, k, v in rows], dec_schema)
    sched = _schedule(spark, [("P", "S", "SS", D(2020, 1, 1), D(2020, 4, 9))])
    a = sorted(tuple(r) for r in planned_value(_budget(spark), sched, as_double).collect())
    b = sorted(tuple(r) for r in planned_value(_budget(spark), sched, as_decimal).collect())
    assert a == b and len(a) > 50


def _exact_inputs(spark):
    """Budgets of many digits and negative ones, a curve with repeated, missing and null values, odd durations."""
    kind = "SUBSTAGES string, PERCENT_COMPLETIONTIME double, NORM_PERCENT_CUMSPENT decimal(18,10)"
    points = [("SS - x", k / 100, None if k == 50 else Decimal((k * 7) % 60) / 100 + Decimal(k) * Decimal("0.0000000123"))
              for k in range(101) if k != 37]
    curve = spark.createDataFrame(points + [("T - y", k / 100, Decimal(k // 10) / 10) for k in range(101)], kind)
    keys = [(f"P{i}", "S", "SS" if i % 3 else "T" if i % 2 else "NONE") for i in range(12)]
    budget = _budget(spark, [(*k, Decimal("98765432101234.5679") * (-1) ** i / (i + 1)) for i, k in enumerate(keys)])
    schedule = _schedule(spark, [(*k, D(2019, 12, 1, i), D(2019, 12, 1, i) + dt.timedelta(days=3 + i * 37))
                                 for i, k in enumerate(keys)])
    return budget, schedule, curve, keys


@pytest.mark.parametrize("method", ["bucket", "daily"])
def test_planned_curve_by_key_equals_windows_over_its_rows(spark, method):
    from costcurves.operators.planned import dedup_and_accumulate

    budget, schedule, curve, _ = _exact_inputs(spark)
    got = planned_value(budget, schedule, curve, method=method)
    want = dedup_and_accumulate(planned_daily(budget, schedule, curve))
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_forecast_of_inputs_equals_that_of_planned_rows(spark):
    from costcurves.operators.forecast import forecast_of_inputs, future_weights, future_weights_of_inputs
    from costcurves.schema import KEY

    budget, schedule, curve, keys = _exact_inputs(spark)
    source = spark.createDataFrame([(*k, D(2020, 1, 1 + i), Decimal("40.10")) for i, k in enumerate(keys[:-2])], COST_SOURCE)
    actual = actual_value([source], budget, schedule)
    planned = planned_value(budget, schedule, curve)
    for as_of in (dt.date(2019, 11, 1), dt.date(2019, 12, 20), dt.date(2020, 6, 1), dt.date(2030, 1, 1)):
        for new, old in ((forecast_of_inputs, forecast_value), (future_weights_of_inputs, future_weights)):
            got, want = new(budget, schedule, curve, actual, as_of), old(planned, actual, as_of)
            assert got.dtypes == want.dtypes and got.columns[:3] == KEY
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_planned_and_forecast_rows_are_neither_shuffled_nor_sorted(spark):
    from costcurves.operators.forecast import forecast_of_inputs

    budget, schedule, curve, keys = _exact_inputs(spark)
    source = spark.createDataFrame([(*k, D(2020, 1, 1), Decimal("40.10")) for k in keys], COST_SOURCE)
    actual = actual_value([source], budget, schedule)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (planned_value(budget, schedule, curve), forecast_of_inputs(budget, schedule, curve, actual, dt.date(2020, 1, 5))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            above = plan[:plan.index("Generate inline(CURVE")]
            assert not any(x in above for x in ("Exchange", "Sort", "Window", "Aggregate", "Join"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
