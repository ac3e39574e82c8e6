"""Sinks, the staged job, and plan-shape checks (pushdown, pruning, shuffles)."""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from costcurves.operators.actuals import actual_value
from costcurves.operators.forecast import forecast_value
from costcurves.operators.planned import planned_value
from costcurves.plans.jobs import build_curves, run_curves
from costcurves.schema import KEY
from costcurves.sources.fixtures import AS_OF, fixture_inputs
from costcurves.sources.tables import CostInputs
from costcurves.sources.sinks import backup_table, preview, recent_rows, refresh_table, write_table


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_run_curves_writes_four_tables(spark, sf_dir):
    head = run_curves(spark, fixture_inputs(spark, sf_dir), as_of=AS_OF,
                      tables={"actual": "T_ACT", "planned": "T_PLAN",
                              "forecast": "T_FC", "combined": "T_COMB"})
    assert len(head.collect()) == 10
    curves = build_curves(fixture_inputs(spark, sf_dir), as_of=AS_OF)
    for name, df in [("T_ACT", curves.actual), ("T_PLAN", curves.planned),
                     ("T_FC", curves.forecast), ("T_COMB", curves.combined)]:
        stored = spark.table(name)
        assert stored.columns == df.columns
        assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0


def test_forecast_over_stored_curves_shuffles_only_per_key_sums(spark, sf_dir):
    run_curves(spark, fixture_inputs(spark, sf_dir), as_of=AS_OF,
               tables={"actual": "B_ACT", "planned": "B_PLAN",
                       "forecast": "B_FC", "combined": "B_COMB"}, buckets=4)
    # at scale neither side is broadcastable: check the sort-merge path
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = _plan(forecast_value(spark.table("B_PLAN"), spark.table("B_ACT"), as_of=AS_OF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert "SortMergeJoin" in plan and "Window" in plan


def test_backup_and_refresh(spark, sf_dir):
    inv = fixture_inputs(spark, sf_dir).invoice
    write_table(inv, "T_INVOICE")
    target = backup_table(spark, "T_INVOICE")
    assert target == "T_INVOICE_BACKUP"
    assert spark.table(target).count() == inv.count()
    with pytest.raises(Exception):
        backup_table(spark, "T_INVOICE")          # CTAS does not replace
    refresh_table(spark, "T_INVOICE_RECENT", spark.table("T_INVOICE"), as_of=AS_OF, years=2)
    since = dt.datetime(AS_OF.year - 2, AS_OF.month, AS_OF.day)
    got = spark.table("T_INVOICE_RECENT")
    assert got.filter(F.col("INVOICE_DATE") < F.lit(since)).count() == 0
    assert got.count() == inv.filter(F.col("INVOICE_DATE") >= F.lit(since)).count()


def test_recent_filter_reaches_parquet_scan(spark, sf_dir):
    path = os.path.join(tempfile.mkdtemp(prefix="costcurves-scan-"), "invoice")
    fixture_inputs(spark, sf_dir).invoice.write.parquet(path)
    df = recent_rows(spark.read.parquet(path), as_of=AS_OF).select("PROJECTID")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(INVOICE_DATE), GreaterThanOrEqual(INVOICE_DATE" in plan
    assert "ReadSchema: struct<PROJECTID:string,INVOICE_DATE:timestamp_ntz>" in plan


def test_preview_is_deterministic_top_n(spark, sf_dir):
    comb = build_curves(fixture_inputs(spark, sf_dir), as_of=AS_OF).combined
    a = preview(comb, 10, order_by=["TYPE", *KEY, "DATE"]).collect()
    assert len(a) == 10 and all(r.TYPE == "ACTUAL" for r in a)
    assert "TakeOrderedAndProject" in _plan(preview(comb, 10, order_by=["TYPE", *KEY, "DATE"]))


def _stored_inputs(spark, sf_dir):
    """Inputs written as parquet tables, so plans show real scans."""
    base = tempfile.mkdtemp(prefix="costcurves-inputs-")
    i = fixture_inputs(spark, sf_dir)
    out = {}
    for name in ("invoice", "pay_app", "pay_req", "budget", "schedule", "norm_curve"):
        p = os.path.join(base, name)
        getattr(i, name).write.parquet(p)
        out[name] = spark.read.parquet(p)
    return out


def test_actual_plan_pre_aggregates_before_shuffle(spark, sf_dir):
    t = _stored_inputs(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = actual_value([t["invoice"], t["pay_app"], t["pay_req"]], t["budget"], t["schedule"])
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # partial sums are computed on the map side of the (key, day) shuffle
    assert "partial_sum" in plan
    # cost sources read only the five used columns
    assert plan.count("ReadSchema: struct<PROJECTID:string,STAGEPHASE_CODE:string,"
                      "SUBSTAGEACTIVITY_CODE:string,INVOICE_DATE:timestamp_ntz,"
                      "ACTUALS_COST:") == 3


def test_actual_reads_each_source_once_under_adaptive_execution(spark, sf_dir):
    t = _stored_inputs(spark, sf_dir)
    df = actual_value([t["invoice"], t["pay_app"], t["pay_req"]], t["budget"], t["schedule"])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert final.count("ReadSchema: struct<PROJECTID:string,STAGEPHASE_CODE") == 3
    assert "ReusedExchange" in final


def test_forecast_has_no_self_join_and_pushes_date(spark, sf_dir):
    t = _stored_inputs(spark, sf_dir)
    base = tempfile.mkdtemp(prefix="costcurves-curves-")
    actual = actual_value([t["invoice"], t["pay_app"], t["pay_req"]], t["budget"], t["schedule"])
    planned = planned_value(t["budget"], t["schedule"], t["norm_curve"])
    actual.write.parquet(os.path.join(base, "a"))
    planned.write.parquet(os.path.join(base, "p"))
    a, p = spark.read.parquet(os.path.join(base, "a")), spark.read.parquet(os.path.join(base, "p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(forecast_value(p, a, as_of=AS_OF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin")
    assert joins == 1
    assert "GreaterThan(DATE,2001-03-01T00:00)" in plan


def test_building_curves_starts_no_job(spark, sf_dir):
    t = _stored_inputs(spark, sf_dir)
    spark.sparkContext.setJobGroup("build-only", "build-only")
    try:
        build_curves(CostInputs(**t), as_of=AS_OF)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cost_rows_never_meet_an_exchange_on_the_key_alone(spark, sf_dir):
    """(key, date) rows are dealt by (key, date) and (key, day) only."""
    t = _stored_inputs(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(actual_value([t["invoice"], t["pay_app"], t["pay_req"]], t["budget"], t["schedule"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    for k, line in enumerate(lines):
        dealt = re.search(r"hashpartitioning\(([^)]*)\)", line)
        if dealt and "_DAY" not in dealt[1] and "INVOICE_DATE" not in dealt[1]:
            below = next(x for x in lines[k + 1:] if "Project" in x or "Aggregate" in x or "Exchange" in x)
            assert "INVOICE_DATE" not in below, below


def test_failed_overwrite_keeps_the_old_table(spark, sf_dir):
    write_table(spark.range(5).toDF("x"), "KEPT")
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        write_table(bad, "KEPT")
    assert sorted(r.x for r in spark.table("KEPT").collect()) == [0, 1, 2, 3, 4]
    write_table(spark.range(2).toDF("x"), "KEPT")
    assert spark.table("KEPT").count() == 2
    assert not [t.name for t in spark.catalog.listTables() if "staging" in t.name.lower()]


@pytest.mark.parametrize("partitions", [None, ["k"]])
def test_failed_last_step_keeps_the_old_table(spark, monkeypatch, partitions):
    """Overwrite and refresh write a table once and swap at the end: a failure of the swap itself leaves the old rows."""
    from costcurves.sources import sinks

    name = f"SWAP_{len(partitions or [])}"
    frame = lambda n: spark.range(n).select("id", F.concat(F.lit("a b="), F.col("id") % 2).alias("k"),
                                            F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz").alias("INVOICE_DATE"))
    write_table(frame(6), name, partition_by=partitions)
    real, calls = sinks._rename, []

    def rename(spark, a, b):
        calls.append((a, b))
        if "staging" in a:
            raise RuntimeError("the swap fails")
        real(spark, a, b)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_rename", rename)
        for run in (lambda: write_table(frame(2), name, partition_by=partitions),
                    lambda: refresh_table(spark, name, frame(3), as_of=dt.date(2001, 6, 1))):
            with pytest.raises(RuntimeError):
                run()
            assert sorted(r.id for r in spark.table(name).collect()) == list(range(6))
    write_table(frame(4), name, partition_by=partitions)
    assert sorted((r.id, r.k) for r in spark.table(name).collect()) == [(i, f"a b={i % 2}") for i in range(4)]
    refresh_table(spark, name, frame(3), as_of=dt.date(2001, 6, 1))
    assert spark.table(name).count() == 3 and spark.table(name).filter("k = 'a b=1'").count() == 1
    assert not [t.name for t in spark.catalog.listTables() if name.lower() in t.name.lower() and t.name.lower() != name.lower()]


def test_refresh_keeps_the_table_definition(spark, sf_dir):
    inv = fixture_inputs(spark, sf_dir).invoice
    spark.sql("DROP TABLE IF EXISTS R_INVOICE")
    inv.limit(0).write.format("parquet").bucketBy(3, "PROJECTID").option("note", "mine").saveAsTable("R_INVOICE")
    refresh_table(spark, "R_INVOICE", inv, as_of=AS_OF)
    refresh_table(spark, "R_INVOICE", inv, as_of=AS_OF)
    text = "\n".join(str(r) for r in spark.sql("DESCRIBE EXTENDED R_INVOICE").collect())
    assert "Num Buckets" in text and "note=mine" in text
    assert spark.table("R_INVOICE").count() == recent_rows(inv, as_of=AS_OF).count()


def test_stages_from_catalog_tables(spark, sf_dir):
    """The six inputs as catalog tables under their upstream names, the four
    stages run one by one reading each other's tables by name."""
    from costcurves.plans.jobs import (
        run_actual_stage,
        run_combined_stage,
        run_forecast_stage,
        run_planned_stage,
    )
    from costcurves.sources.tables import DEFAULT_TABLES, CostInputs

    fixture = fixture_inputs(spark, sf_dir)
    names = {field: f"C_{table}" for field, table in DEFAULT_TABLES.items()}
    for field, table in names.items():
        write_table(getattr(fixture, field), table)
    inputs = CostInputs.from_catalog(spark, names)
    run_actual_stage(spark, inputs, "C_ACT")
    run_planned_stage(spark, inputs, "C_PLAN")
    run_forecast_stage(spark, AS_OF, "C_ACT", "C_PLAN", "C_FC")
    head = run_combined_stage(spark, "C_ACT", "C_PLAN", "C_FC", "C_COMB")
    assert len(head.collect()) == 10
    expected = build_curves(fixture, as_of=AS_OF).combined
    got = spark.table("C_COMB")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_command_line_runs_stages_and_score(spark, sf_dir):
    from costcurves.__main__ import main
    from costcurves.sources.tables import DEFAULT_TABLES

    fixture = fixture_inputs(spark, sf_dir)
    args = []
    for field in DEFAULT_TABLES:
        write_table(getattr(fixture, field), f"M_{field.upper()}")
        args += [f"--{field.replace('_', '-')}-table", f"M_{field.upper()}"]
    outs = ["--actual-output", "M_ACT", "--planned-output", "M_PLAN",
            "--forecast-output", "M_FC", "--combined-output", "M_COMB"]
    main(["all", "--as-of", str(AS_OF), *args, *outs], spark=spark)
    main(["quality", "--as-of", str(AS_OF), "--output", "M_SCORE", *args, *outs], spark=spark)
    assert spark.table("M_COMB").count() == build_curves(fixture, as_of=AS_OF).combined.count()
    score = {r.check: r for r in spark.table("M_SCORE").collect()}
    assert "OVERALL" in score and score["OVERALL"].checked > 0


def test_plain_sql_over_written_tables(spark, sf_dir):
    """Checks written as SQL against the default table names give what the
    DataFrame checks give."""
    from costcurves.operators import quality as q

    fixture = fixture_inputs(spark, sf_dir)
    run_curves(spark, fixture, as_of=AS_OF)
    by_sql = spark.sql("""
        SELECT 'ACTUAL' AS source, COUNT(DISTINCT PROJECT_NUMBER) AS project_count FROM ACTUALVALUE
        UNION ALL SELECT 'PLANNED', COUNT(DISTINCT PROJECT_NUMBER) FROM PLANNEDVALUE
        UNION ALL SELECT 'FORECAST', COUNT(DISTINCT PROJECT_NUMBER) FROM FORECASTVALUE""")
    by_df = q.completeness_check(spark.table("ACTUALVALUE"), spark.table("PLANNEDVALUE"),
                                 spark.table("FORECASTVALUE"))
    assert sorted(by_sql.collect()) == sorted(by_df.collect())

    cont_sql = spark.sql("""
        WITH a AS (SELECT PROJECT_NUMBER, MAX(INVOICE_DATE) AS max_actual_date
                   FROM ACTUALVALUE GROUP BY PROJECT_NUMBER),
             f AS (SELECT PROJECT_NUMBER, MIN(FORECAST_DATE) AS min_forecast_date
                   FROM FORECASTVALUE GROUP BY PROJECT_NUMBER)
        SELECT a.PROJECT_NUMBER, max_actual_date, min_forecast_date,
               IF(min_forecast_date > max_actual_date, 'PASS', 'FAIL') AS continuity_check
        FROM a JOIN f ON a.PROJECT_NUMBER = f.PROJECT_NUMBER""")
    cont_df = q.continuity_check(spark.table("ACTUALVALUE"), spark.table("FORECASTVALUE"))
    assert sorted(cont_sql.collect()) == sorted(cont_df.collect())

    write_table(fixture.invoice, "SQL_INVOICE")
    recent_sql = spark.sql(f"""
        SELECT COUNT(*) FROM SQL_INVOICE
        WHERE INVOICE_DATE >= DATEADD(YEAR, -2, DATE'{AS_OF}')""").first()[0]
    assert recent_sql == recent_rows(spark.table("SQL_INVOICE"), as_of=AS_OF).count()


def test_combined_table_prunes_by_type(spark, sf_dir):
    run_curves(spark, fixture_inputs(spark, sf_dir), as_of=AS_OF,
               tables={"actual": "P_ACT", "planned": "P_PLAN", "forecast": "P_FC", "combined": "P_COMB"})
    table = spark.table("P_COMB")
    assert table.columns == ["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "DATE", "VALUE", "TYPE"]
    plan = _plan(table.filter(F.col("TYPE") == "FORECAST").select("VALUE"))
    assert "PartitionFilters: [isnotnull(TYPE" in plan and "(TYPE#" in plan
