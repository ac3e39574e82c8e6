"""Rows are shuffled, and inputs read, as often as the plans say."""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from costcurves.operators import summaries, temporal
from costcurves.operators.actuals import actual_value, position_of_costs
from costcurves.operators.forecast import actual_position
from costcurves.operators.planned import planned_value
from costcurves.plans import incremental, jobs, registry
from costcurves.schema import KEY
from costcurves.session import shared_folder
from costcurves.sources.fixtures import fixture_inputs

NAMES = "PROJECT_NUMBER string, STAGE string, SUB_STAGE string"


@pytest.fixture
def plain(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def shuffles(df, *columns: str) -> int:
    """Shuffles, reused ones aside, by keys among which are these columns."""
    dealt = [re.search(r"hashpartitioning\(([^)]*)\)", x)[1] for x in plan(df) if "Exchange hashpartitioning" in x and "Reused" not in x]
    return sum(all(c in d for c in columns) for d in dealt)


def test_as_of_join_shuffles_its_rows_once(plain):
    a = plain.createDataFrame([], f"{NAMES}, DATE timestamp_ntz, TYPE string")
    b = plain.createDataFrame([], f"{NAMES}, KNOWN timestamp_ntz, V decimal(38,10)")
    found = temporal.as_of_join(a, b, KEY, "DATE", "KNOWN", ["V"])
    assert sum("REPARTITION_BY_COL" in x and "Reused" not in x for x in plan(found)) == 1
    # The rows, and what each block has from before.
    assert shuffles(found, "_BLOCK") == 2
    assert shuffles(found, "_TIME") == 0


def test_as_of_join_ties_and_nulls(spark):
    day = dt.datetime(2020, 1, 1)
    a = spark.createDataFrame([("P", "S", "A", day, 1), ("P", "S", "A", None, 2), (None, "S", "A", day, 3)], f"{NAMES}, DATE timestamp_ntz, N int")
    b = spark.createDataFrame([("P", "S", "A", day, 5), ("P", "S", "A", day, None), ("P", "S", "A", day, 4)], f"{NAMES}, DATE timestamp_ntz, V int")
    got = {r.N: r.V for r in temporal.as_of_join(a, b, KEY, "DATE", "DATE", ["V"]).collect()}
    assert got == {1: 5, 2: None, 3: None}


def test_merge_shuffles_the_state_once(plain):
    state = plain.createDataFrame([], incremental.STATE)
    found = incremental.merged(state, state.select(*KEY, "INVOICE_DATE", "ACTUALS_COST", "PART"))
    assert sum("REPARTITION_BY_COL" in x and "Reused" not in x for x in plan(found)) == 1
    assert shuffles(found, "INVOICE_DATE") == 0


def test_shortfalls_compute_the_curve_once(plain, sf_dir):
    i = fixture_inputs(plain, sf_dir)
    base = tempfile.mkdtemp(prefix="costcurves-scale-")
    sources = []
    for name in ("invoice", "pay_app", "pay_req"):
        getattr(i, name).write.parquet(os.path.join(base, name))
        sources.append(plain.read.parquet(os.path.join(base, name)))
    found = summaries.shortfall_episodes(actual_value(sources, i.budget, i.schedule))
    assert sum("struct<PROJECTID:string,STAGEPHASE_CODE" in x for x in plan(found)) == 3


def test_planned_rows_of_buckets_are_made_after_the_shuffle(plain, sf_dir):
    i = fixture_inputs(plain, sf_dir)
    lines = plan(planned_value(i.budget, i.schedule, i.norm_curve, deal=8))
    made = next(k for k, x in enumerate(lines) if "Generate inline" in x)
    assert not any("Exchange" in x for x in lines[:made])


def test_stored_plans_cut_budget_and_schedule_from_the_facts(spark, sf_dir):
    stored = jobs.stored_plans(fixture_inputs(spark, sf_dir))
    for df in (stored.budget, stored.schedule):
        assert "l_extendedprice" not in "\n".join(plan(df)) and "l_suppkey" not in "\n".join(plan(df))
    shared = registry._planned_inputs(spark, sf_dir)
    assert "l_suppkey" not in "\n".join(plan(shared.schedule))
    assert sorted(map(str, shared.schedule.collect())) == sorted(map(str, fixture_inputs(spark, sf_dir).schedule.collect()))


def test_curve_queries_join_and_deal_the_costs_once(plain, sf_dir):
    _, c = registry._curves(plain, sf_dir)
    for df in (c.combined, c.forecast, c.position):
        lines = plan(df)
        assert "l_extendedprice" not in "\n".join(lines)
        # The union of the sources is summed once, by key and date, and dealt once, by key and block.
        assert shuffles(df, "INVOICE_DATE") == 1
        assert sum("REPARTITION_BY_COL" in x and "Reused" not in x for x in lines) == 1
    # No row of the actual curve is made for the forecast.
    assert not any("Join" in x and "_DAYS" in x for x in plan(c.forecast))


COST = "PROJECTID string, STAGEPHASE_CODE string, SUBSTAGEACTIVITY_CODE string, INVOICE_DATE timestamp_ntz, ACTUALS_COST decimal(18,2)"


def test_position_of_costs_is_that_of_the_curve(spark):
    d0 = dt.datetime(2019, 12, 30)
    rows = [("P", "S", "A", d0 + dt.timedelta(days=d), Decimal(c)) for d, c in ((0, 10), (0, 5), (300, -4), (900, 7), (901, 3), (901, -3))]
    rows += [("Q", "S", "A", d0, Decimal(2)), ("Q", "S", "A", d0, Decimal(-2)), ("R", "S", "A", d0, Decimal(1)), (None, "S", "A", d0, Decimal(9)),
             ("R", "S", "A", None, Decimal(9)), ("T", "S", "A", d0 - dt.timedelta(days=40_000), Decimal(4))]
    costs = spark.createDataFrame(rows, COST)
    budget = spark.createDataFrame([("P", "S", "A", Decimal(5)), ("P", "S", "A", Decimal(6)), ("T", "S", "A", None)],
                                   f"{NAMES}, BUDGET_CURRENT_APPROVED decimal(20,4)")
    schedule = spark.createDataFrame([("P", "S", "A", d0, d0), ("P", "S", "A", d0, None)], "PROJECTID string, STAGECODE string, "
                                     "STAGESUBSTAGECODE string, CURRENTSTART timestamp_ntz, CURRENTEND timestamp_ntz")
    want = actual_position(actual_value([costs, costs], budget, schedule))
    got = position_of_costs([costs, costs], budget, schedule)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3
    assert {r.PROJECT_NUMBER: int(r.TOTAL_ACTUAL_COST) for r in got.collect()} == {"P": 72, "R": 2, "T": 8}


def kept_state(spark, name):
    """A state of two merged batches of 40 keys, and the second batch."""
    d0 = dt.datetime(2020, 1, 1)
    batch = lambda days, c: spark.createDataFrame(
        [(f"P{k}", "S", "A", d0 + dt.timedelta(days=d), Decimal(c + k)) for k in range(40) for d in days], COST)
    state = incremental.CostState(spark, shared_folder(spark, name), parts=4)
    state.merge([batch((0, 300, 700), 1)], "b1")
    return state, batch((10, 300, 800), 5)


def test_merge_of_stored_rows_shuffles_them_once_and_writes_them_where_they_lie(plain):
    state, _ = kept_state(plain, "test-stored")
    rows = state.rows().filter(F.col("PART").isin([0, 1, 2, 3]))
    found = incremental.merged(rows, rows.select(*KEY, "INVOICE_DATE", "ACTUALS_COST", "PART"))
    lines = plan(found)
    assert sum("REPARTITION_BY_COL" in x and "Reused" not in x for x in lines) == 1
    # The rows, one row a block to its key, and back.
    assert sum("Exchange hashpartitioning" in x and "Reused" not in x for x in lines) == 3
    assert not any("Join" in x for x in lines)
    made = found.withColumn("_TASK", F.spark_partition_id())
    blocks = made.groupBy("PART", temporal.block_of(F.col("INVOICE_DATE"), temporal.ROW_DAYS)).agg(F.countDistinct("_TASK").alias("n"))
    assert {r.n for r in blocks.collect()} == {1}


def test_merge_goes_on_where_moving_folders_ended(spark, monkeypatch):
    state, second = kept_state(spark, "test-moved")
    whole, _ = kept_state(spark, "test-whole")
    whole.merge([second], "b2")
    real, moved = incremental.CostState._path, []

    def path(self, name):
        if "/state/PART=" in name:
            moved.append(name)
            if len(moved) == 3:
                raise RuntimeError("the driver ends here")
        return real(self, name)

    with monkeypatch.context() as m:
        m.setattr(incremental.CostState, "_path", path)
        with pytest.raises(RuntimeError):
            state.merge([second], "b2")
    state.merge([second], "b2")
    state.merge([second], "b2")
    rows = lambda s: sorted(map(str, s.rows().collect()))
    assert len(moved) == 3 and rows(state) == rows(whole) and state.rows().count() == 40 * 5


def test_totals_by_key_and_date_are_not_shuffled_to_meet_the_state(plain, monkeypatch):
    state, second = kept_state(plain, "test-totals")
    totals = second.toDF(*KEY, "INVOICE_DATE", "ACTUALS_COST").repartition(*KEY, "INVOICE_DATE")
    found = []
    monkeypatch.setattr(incremental.CostState, "_write", lambda self, changes, batch: found.append(changes))
    state.set_totals(totals, "t")
    # The totals as they come, and the state.
    assert shuffles(found[0], "INVOICE_DATE") == 2
    assert {(r.PROJECT_NUMBER, (r.INVOICE_DATE - dt.datetime(2020, 1, 1)).days): int(r.ACTUALS_COST) for r in found[0].collect()} == {
        (f"P{k}", d): 4 if d == 300 else 5 + k for k in range(40) for d in (10, 300, 800)}


def test_stream_query_writes_its_files_without_a_shuffle(spark, sf_dir, monkeypatch):
    """Each source's files are read in two micro-batches, and its rows are not shuffled to make them."""
    written, real = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **b):
        if "/in/" in path:
            written.append("\n".join(plan(self._df)))
        return real(self, path, *a, **b)

    batches, totals = [], incremental.CostState.set_totals
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(incremental.CostState, "set_totals", lambda self, rows, batch: (batches.append(batch), totals(self, rows, batch)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        registry.streamed_actual_value(spark, sf_dir)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(written) == 3 and not any("Exchange" in x for x in written)
    assert len(batches) == 2
