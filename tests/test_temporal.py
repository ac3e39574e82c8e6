"""As-of and interval joins, incremental totals, the stream, sketches, cube, episodes and monthly refresh."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costcurves.operators import sketches, summaries, temporal
from costcurves.operators.actuals import actual_value
from costcurves.plans.incremental import CostState
from costcurves.plans.registry import queries
from costcurves.schema import COST_SOURCE, KEY
from costcurves.session import shared_folder
from costcurves.sources.fixtures import AS_OF, fixture_inputs
from costcurves.sources.monthly import refresh_months
from costcurves.streaming import stream_costs

D0 = dt.datetime(2020, 1, 1)


def plan_of(df, adaptive="false"):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def key_rows(rnd, n, keys=3, days=400):
    return [(f"P{rnd.randrange(keys)}" if rnd.random() > 0.03 else None, "S", "A",
             D0 + dt.timedelta(days=rnd.randrange(-days, days), hours=rnd.choice([0, 0, 0, 7])) if rnd.random() > 0.03 else None,
             rnd.randrange(100)) for _ in range(n)]


@pytest.mark.parametrize("block_days", [1, 32, 100000])
def test_as_of_join_equals_plain_search(spark, block_days):
    rnd = random.Random(block_days)
    left = key_rows(rnd, 300)
    right = [r[:4] + (None if rnd.random() < 0.1 else r[4],) for r in key_rows(rnd, 200)]
    schema = "PROJECT_NUMBER string, STAGE string, SUB_STAGE string, {} timestamp_ntz, {} int"
    a, b = spark.createDataFrame(left, schema.format("DATE", "N")), spark.createDataFrame(right, schema.format("KNOWN", "V"))
    got = temporal.as_of_join(a, b, KEY, "DATE", "KNOWN", ["V"], block_days)
    assert got.columns == [*KEY, "DATE", "N", "KNOWN", "V"]
    want = []
    for p, s, u, d, n in left:
        found = [(t, v) for q, _, _, t, v in right if None not in (p, d, t) and q == p and t <= d]
        last = max((t for t, _ in found), default=None)
        values = [v for t, v in found if t == last]
        want.append((p, s, u, d, n, last, max((v for v in values if v is not None), default=None)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_as_of_join_refuses_clashes_and_takes_empty_sides(spark):
    a = spark.createDataFrame([], "K string, T timestamp_ntz, V int")
    b = spark.createDataFrame([("k", D0, 1)], "K string, U timestamp_ntz, W int")
    assert temporal.as_of_join(a, b, ["K"], "T", "U", ["W"]).count() == 0
    assert [tuple(r) for r in temporal.as_of_join(b, a.withColumnRenamed("V", "X"), ["K"], "U", "T", ["X"]).collect()] == [
        ("k", D0, 1, None, None)]
    with pytest.raises(ValueError):
        temporal.as_of_join(a, b.withColumnRenamed("W", "V"), ["K"], "T", "U", ["V"])


@pytest.mark.parametrize(("days", "fan"), [(1, 2), (32, 64), (7, 3)])
def test_covering_join_equals_all_pairs(spark, days, fan):
    rnd = random.Random(days)
    points = [(f"K{rnd.randrange(3)}", i, D0 + dt.timedelta(days=rnd.randrange(-900, 900), hours=rnd.randrange(24))) for i in range(200)]
    points += [("K0", 900, None), (None, 901, D0)]
    spans = []
    for j in range(60):
        start = D0 + dt.timedelta(days=rnd.randrange(-900, 900), hours=rnd.randrange(24))
        length = rnd.choice([0, 1, 30, 300, 5000, 100000, -5])
        spans.append((f"K{rnd.randrange(3)}", j, start, start + dt.timedelta(days=length)))
    spans += [("K0", 70, None, D0), ("K0", 71, D0, None), (None, 72, D0, D0), ("K0", 73, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31))]
    a = spark.createDataFrame(points, "K string, I int, T timestamp_ntz")
    b = spark.createDataFrame(spans, "K string, J int, S timestamp_ntz, E timestamp_ntz")
    got = sorted((r.I, r.J) for r in temporal.covering_join(a, b, ["K"], "T", "S", "E", days, fan).collect())
    want = sorted((i, j) for k, i, t in points for q, j, s, e in spans if None not in (k, t, s, e) and k == q and s <= t <= e)
    assert got == want


def test_covering_join_has_no_key_only_join(spark):
    a = spark.range(10).select(F.lit("k").alias("K"), F.lit(D0).cast("timestamp_ntz").alias("T"), "id")
    b = spark.range(10).select(F.lit("k").alias("K"), F.lit(D0).cast("timestamp_ntz").alias("S"),
                               F.lit(D0).cast("timestamp_ntz").alias("E"), F.col("id").alias("J"))
    a, b = a.unionByName(a), b.unionByName(b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(temporal.covering_join(a, b, ["K"], "T", "S", "E"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    assert "_BUCKET" in join and "_LEVEL" in join


def test_running_values_in_two_levels(spark):
    rnd = random.Random(3)
    rows = {(f"K{rnd.randrange(3)}", D0 + dt.timedelta(days=rnd.randrange(-500, 500), hours=rnd.randrange(3))): rnd.randrange(-50, 50)
            for _ in range(400)}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in rows.items()], "K string, T timestamp_ntz, V long")
    for combine, plain in ((F.sum, sum), (F.max, max), (F.min, min)):
        got = {(r.K, r["T"]): r.R for r in temporal.running(df, ["K"], "T", "V", "R", combine).collect()}
        assert got == {(k, t): plain(v for (q, u), v in rows.items() if q == k and u <= t) for k, t in rows}


def cost_rows(spark, rows):
    return spark.createDataFrame([(p, "S", "A", D0 + dt.timedelta(days=d), Decimal(c)) for p, d, c in rows], COST_SOURCE)


def files_of(state):
    return {p: sorted(os.listdir(p)) for p in glob.glob(state.table.removeprefix("file:").replace("//", "/") + "/PART=*")}


def test_late_batches_shift_later_days_and_leave_other_folders(spark):
    state = CostState(spark, shared_folder(spark, "test-state"), parts=8)
    first = [(f"P{i}", d, 10 + i) for i in range(20) for d in (0, 50, 100)]
    state.merge([cost_rows(spark, first)], "b1")
    before = files_of(state)
    late = [("P3", 50, -13), ("P3", 20, 5), ("P3", 100, 1), ("P3", 200, 7), (None, 3, 9)]
    state.merge([cost_rows(spark, late)], "b2")
    after = files_of(state)
    changed = [p for p in before if before[p] != after[p]]
    assert len(changed) == 1 and len(before) > 3
    state.merge([cost_rows(spark, late)], "b2")  # delivered again
    assert files_of(state) == after
    rows = {(r.PROJECT_NUMBER, (r.INVOICE_DATE - D0).days): (int(r.ACTUALS_COST), int(r.RUNNING_COST)) for r in state.rows().collect()}
    assert [rows["P3", d] for d in (0, 20, 50, 100, 200)] == [(13, 13), (5, 18), (0, 18), (14, 32), (7, 39)]
    assert [rows["P4", d] for d in (0, 50, 100)] == [(14, 14), (14, 28), (14, 42)]
    state.merge([cost_rows(spark, [])], "b3")
    assert files_of(state) == after


def test_interrupted_merge_is_taken_up(spark, monkeypatch):
    state = CostState(spark, shared_folder(spark, "test-state"), parts=2)
    state.merge([cost_rows(spark, [("P1", 0, 1), ("P2", 0, 2)])], "b1")

    def broken(self, *_):
        raise RuntimeError("the driver ends here")

    with monkeypatch.context() as m:
        m.setattr(CostState, "_replace", broken)
        with pytest.raises(RuntimeError):
            state.merge([cost_rows(spark, [("P1", 5, 4)])], "b2")
    assert state.rows().count() == 2
    state.merge([cost_rows(spark, [("P1", 5, 4)])], "b2")
    assert sorted((r.PROJECT_NUMBER, int(r.RUNNING_COST)) for r in state.rows().collect()) == [("P1", 1), ("P1", 5), ("P2", 2)]


def test_random_batches_equal_full_run(spark):
    rnd = random.Random(9)
    batches = [[(f"P{rnd.randrange(4)}", rnd.randrange(300), rnd.randrange(-40, 60)) for _ in range(60)] for _ in range(4)]
    state = CostState(spark, shared_folder(spark, "test-state"), parts=3)
    for i, b in enumerate(batches):
        state.merge([cost_rows(spark, b)], f"b{i}")
    budget = spark.createDataFrame([("P0", "S", "A", Decimal(5))], "PROJECT_NUMBER string, STAGE string, SUB_STAGE string, "
                                   "BUDGET_CURRENT_APPROVED decimal(20,4)")
    schedule = spark.createDataFrame([("P0", "S", "A", D0, D0)] * 2, "PROJECTID string, STAGECODE string, STAGESUBSTAGECODE string, "
                                     "CURRENTSTART timestamp_ntz, CURRENTEND timestamp_ntz")
    want = actual_value([cost_rows(spark, [r for b in batches for r in b])], budget, schedule)
    as_rows = lambda df: sorted(str([float(x) if isinstance(x, Decimal) else x for x in r]) for r in df.collect())
    assert as_rows(state.curve(budget, schedule)) == as_rows(want)


def test_stream_in_any_order_with_restart(spark):
    """Files in two orders, a credit for an old date last, and a stream that ends and goes on."""
    rows = [("P1", d, 10) for d in range(6)] + [("P2", 3, 5)]
    credit = [("P1", 1, -10), ("P1", 4, 2)]
    found = []
    for order in ([rows[:4], rows[4:], credit], [credit, rows[4:], rows[:4]]):
        base = shared_folder(spark, "test-stream")
        state = CostState(spark, f"{base}/table", parts=2)
        for k, part in enumerate(order):
            cost_rows(spark, part).coalesce(1).write.mode("append").parquet(f"{base}/in")
            if k:  # the first two files come together, the last one after a restart
                stream_costs(spark, {f"{base}/in": COST_SOURCE}, state, f"{base}/checkpoint", files_at_once=1).awaitTermination()
        found.append(sorted((r.PROJECT_NUMBER, r.INVOICE_DATE, int(r.ACTUALS_COST), int(r.RUNNING_COST)) for r in state.rows().collect()))
    assert found[0] == found[1]
    assert [(r[2], r[3]) for r in found[0] if r[0] == "P1"] == [(10, 10), (0, 10), (10, 20), (10, 30), (12, 42), (10, 52)]


def test_sketches_merge_and_count(spark):
    rnd = random.Random(1)
    rows = [(f"P{rnd.randrange(9000)}", d, rnd.randrange(10_000)) for d in range(20) for _ in range(1500)]
    a, b = cost_rows(spark, rows[:20_000]), cost_rows(spark, rows[10_000:])
    parts = sketches.project_sketches({"A": a, "B": b})
    assert parts.groupBy("source").count().filter("count > 25").isEmpty()
    got = {r.source: r for r in sketches.sketched_profile(parts).collect()}
    for name, part in (("A", rows[:20_000]), ("B", rows[10_000:])):
        exact = len({p for p, _, _ in part})
        assert abs(got[name].distinct_projects - exact) < 5 * exact * 2 ** (-sketches.LG_ENTRIES / 2)
        assert got[name].row_count == len(part) and not got[name].exact
    few = sketches.sketched_profile(sketches.project_sketches({"A": a.limit(100), "B": cost_rows(spark, [("Z", 0, 1)])}))
    assert {r.source: (r.exact, r.missing_projects) for r in few.collect()}["A"] == (True, 1)


def test_sketch_plan_has_no_expand(spark, sf_dir):
    i = fixture_inputs(spark, sf_dir)
    assert "Expand" not in plan_of(sketches.project_sketches(i.cost_sources()))


def test_quantiles_keep_their_rank(spark):
    rnd = random.Random(2)
    costs = [round(rnd.lognormvariate(3, 1), 2) for _ in range(20_000)]
    df = cost_rows(spark, [("P", i % 30, c) for i, c in enumerate(costs)])
    for r in sketches.sketched_quantiles(sketches.cost_sketches({"A": df})).collect():
        assert r["items"] == len(costs)
        below, to = (sum(f(c) for c in costs) / len(costs) for f in (lambda c: c < r.cost, lambda c: c <= r.cost))
        assert below - 2 * sketches.rank_error(400) <= r.quantile <= to + 2 * sketches.rank_error(400)


def test_control_cube_reads_each_side_once(spark, sf_dir):
    i = fixture_inputs(spark, sf_dir)
    src = [i.invoice, i.pay_app, i.pay_req]
    rows = summaries.control_cube(src, actual_value(src, i.budget, i.schedule)).collect()
    assert {r.LEVEL for r in rows} == set(range(8))
    total = next(r for r in rows if r.LEVEL == 7)
    assert total.SOURCE_TOTAL == sum(r.SOURCE_TOTAL for r in rows if r.LEVEL == 0)


def test_shortfall_episodes(spark):
    cums = [5, 9, 7, 8, 9, 12, 11, 3, 20, 19]
    df = spark.createDataFrame([("P", "S", "A", D0 + dt.timedelta(days=40 * i), Decimal(c)) for i, c in enumerate(cums)],
                               "PROJECT_NUMBER string, STAGE string, SUB_STAGE string, INVOICE_DATE timestamp_ntz, "
                               "CUMULATIVE_ACTUAL_COST decimal(38,2)")
    got = summaries.shortfall_episodes(df).orderBy("FIRST_DATE").collect()
    assert [((r.FIRST_DATE - D0).days // 40, r.DATES, r.DAYS, int(r.DEPTH), r.RECOVERED) for r in got] == [
        (2, 2, 41, 2, True), (6, 2, 41, 9, True), (9, 1, 1, 1, False)]


def test_monthly_refresh_keeps_files_of_unchanged_months(spark, sf_dir):
    source = fixture_inputs(spark, sf_dir).invoice
    name = "months_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    refresh_months(spark, name, source, as_of=AS_OF, years=3)
    folder = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    names = lambda: {os.path.basename(p): sorted(os.listdir(p)) for p in glob.glob(f"{folder}/MONTH=*")}
    before = names()
    fixed = source.withColumn("ACTUALS_COST", F.when(F.date_format("INVOICE_DATE", "yyyy-MM") == "2000-06", F.col("ACTUALS_COST") * 2)
                              .otherwise(F.col("ACTUALS_COST")).cast(source.schema["ACTUALS_COST"].dataType))
    done = refresh_months(spark, name, fixed, as_of=AS_OF, years=2)
    after = names()
    assert "2000-06" in done["written"] and all(m <= "1999-03" for m in done["dropped"]) and done["dropped"]
    assert set(done["written"]) <= {"2000-06", "1999-03"}
    kept = [m for m in after if m.removeprefix("MONTH=") not in done["written"]]
    assert kept and all(after[m] == before[m] for m in kept)
    # A refresh from the table itself, and a failing one.
    assert refresh_months(spark, name, spark.table(name).drop("MONTH"), as_of=AS_OF, years=2) == {"written": [], "dropped": []}
    rows = spark.table(name).count()
    bad = source.withColumn("ACTUALS_COST", F.when(F.col("INVOICE_DATE") > "2000-01-01", F.raise_error(F.lit("no"))).otherwise(
        F.col("ACTUALS_COST")).cast(source.schema["ACTUALS_COST"].dataType))
    with pytest.raises(Exception, match="no"):
        refresh_months(spark, name, bad, as_of=AS_OF, years=2)
    assert spark.table(name).count() == rows and names() == after


@pytest.mark.parametrize("name", ["late_invoices", "streamed_actual_value"])
def test_kept_curves_equal_actual_value(spark, sf_dir, name):
    q = queries()
    as_rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert as_rows(q[name](spark, sf_dir)) == as_rows(q["actual_value"](spark, sf_dir))
