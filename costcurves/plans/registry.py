"""Named queries over the test-table adapter (one per operator of the inventory).

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over the whole
derived tables, with exact decimals reported as doubles (``for_report``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import for_report
from ..operators import actuals as act
from ..operators import forecast as fc
from ..operators import planned as pl
from ..operators import quality as q
from ..operators import sketches, summaries, temporal
from ..operators.combine import combined_curves as combined_curves_of
from ..schema import COMBINED_COLUMNS, KEY
from ..session import shared_folder
from ..sources.fixtures import AS_OF, fixture_inputs
from ..sources.monthly import refresh_months
from ..sources.sinks import backup_table, preview, recent_rows, write_table
from ..sources.tables import CostInputs
from ..streaming import stream_costs
from . import jobs
from .incremental import CostState
from .jobs import build_curves, run_curves

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> CostInputs:
    return fixture_inputs(spark, sf_dir)


def _planned_inputs(spark: SparkSession, sf_dir: str) -> CostInputs:
    """The inputs for queries that read them more than once: what they come from is joined and summed once."""
    return fixture_inputs(spark, sf_dir, jobs.stored_in(shared_folder(spark, "funds")))


def _sources(i: CostInputs) -> list[DataFrame]:
    return [i.invoice, i.pay_app, i.pay_req]


def actuals_union(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return act.union_cost_sources(*_sources(i))


def budget_rollup(spark, sf_dir):
    return act.budget_rollup(_inputs(spark, sf_dir).budget)


def actuals_enriched(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return act.enrich_actuals(act.union_cost_sources(*_sources(i)),
                              act.budget_rollup(i.budget), i.schedule)


def actuals_net(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return act.net_actuals(act.union_cost_sources(*_sources(i)),
                           act.budget_rollup(i.budget), i.schedule)


def actual_value(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return act.actual_value(_sources(i), i.budget, i.schedule)


def norm_curve(spark, sf_dir):
    return pl.norm_curve_points(_inputs(spark, sf_dir).norm_curve).drop("RAW_PERCENT")


def planned_inputs(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return pl.planned_inputs(i.budget, i.schedule)


def planned_daily(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return pl.planned_daily(i.budget, i.schedule, i.norm_curve)


def planned_value(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return pl.planned_value(i.budget, i.schedule, i.norm_curve, method="bucket")


def planned_value_by_day(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return pl.planned_value(i.budget, i.schedule, i.norm_curve, method="daily")


def _curves(spark, sf_dir):
    i = jobs.stored_plans(_planned_inputs(spark, sf_dir))
    return i, build_curves(i, as_of=AS_OF)


def actuals_summary(spark, sf_dir):
    return fc.actuals_summary(actual_value(spark, sf_dir))


def last_cumulative(spark, sf_dir):
    return fc.last_cumulative(actual_value(spark, sf_dir))


def future_weights(spark, sf_dir):
    i, c = _curves(spark, sf_dir)
    return fc.future_weights_of_inputs(i.budget, i.schedule, i.norm_curve, c.actual, AS_OF, position=c.position)


def forecast_value(spark, sf_dir):
    return _curves(spark, sf_dir)[1].forecast


def combined_curves(spark, sf_dir):
    return _curves(spark, sf_dir)[1].combined


def combined_preview(spark, sf_dir):
    return preview(_curves(spark, sf_dir)[1].combined, 10, order_by=["TYPE", *KEY, "DATE"])


def recent_refresh(spark, sf_dir):
    return recent_rows(_inputs(spark, sf_dir).invoice, "INVOICE_DATE", AS_OF, years=2)


def source_counts(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return q.source_counts({
        "INVOICE": i.invoice, "PAY_APP": i.pay_app, "PAY_REQ": i.pay_req,
        "UNIFIER_COSTSHEET_SUBSTAGE_FUND": i.budget, "P6_SCHEDULE": i.schedule,
    })


def source_profile(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return q.source_profile(i.cost_sources())


def completeness_check(spark, sf_dir):
    _, c = _curves(spark, sf_dir)
    return q.completeness_check(c.actual, c.planned, c.forecast)


def continuity_check(spark, sf_dir):
    _, c = _curves(spark, sf_dir)
    return q.continuity_check(c.actual, c.forecast)


def monotone_violations(spark, sf_dir):
    return q.monotone_violations(actual_value(spark, sf_dir))


def planned_vs_budget(spark, sf_dir):
    return q.planned_vs_budget(planned_value(spark, sf_dir), _inputs(spark, sf_dir).budget)


def forecast_continuity(spark, sf_dir):
    _, c = _curves(spark, sf_dir)
    return q.forecast_continuity(c.actual, c.forecast, c.position)


def missing_keys(spark, sf_dir):
    i, c = _curves(spark, sf_dir)
    return q.missing_keys(i.budget, c.actual, c.planned, c.forecast)


def control_totals(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return q.control_totals(_sources(i), act.actual_value(_sources(i), i.budget, i.schedule))


def freshness(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return q.freshness(jobs.dated_tables(i, act.actual_value(_sources(i), i.budget, i.schedule)), AS_OF)


def budget_alignment(spark, sf_dir):
    _, c = _curves(spark, sf_dir)
    return q.budget_alignment(c.actual, c.forecast, c.position)


def timeline_check(spark, sf_dir):
    return q.timeline_check(actual_value(spark, sf_dir))


def quality_score(spark, sf_dir):
    i = _planned_inputs(spark, sf_dir)
    return jobs.quality_score(i, AS_OF)


def _net_costs(i: CostInputs) -> DataFrame:
    return act.daily_costs(act.union_cost_sources(*_sources(i)))


def costs_by_schedule(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return temporal.costs_by_schedule(_net_costs(i), i.schedule)


def schedule_row_totals(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return temporal.schedule_row_totals(_net_costs(i), i.schedule)


def curve_as_of(spark, sf_dir):
    c = jobs.stored_curves(_planned_inputs(spark, sf_dir), AS_OF)
    dates = c.planned.select(F.lit("PLANNED").alias("TYPE"), *KEY, "DATE").unionByName(
        c.forecast.select(F.lit("FORECAST").alias("TYPE"), *KEY, F.col("FORECAST_DATE").alias("DATE")))
    return temporal.costs_known_on(dates, c.actual)


def late_invoices(spark, sf_dir):
    """The actual curve after three batches, one a source: the last one holds the credits."""
    i = _planned_inputs(spark, sf_dir)
    state = CostState(spark, shared_folder(spark, "cost-state"))
    for name, source in i.cost_sources().items():
        state.merge([source], name)
    return state.curve(i.budget, i.schedule)


def streamed_actual_value(spark, sf_dir):
    """The actual curve from a stream over files of the three sources."""
    i = _planned_inputs(spark, sf_dir)
    base = shared_folder(spark, "cost-stream")
    folders = {}
    files = 2
    for name, source in i.cost_sources().items():
        # Files as the stored costs are read, without a shuffle; a small table's rows are dealt to two.
        (source if source.rdd.getNumPartitions() > 1 else source.repartition(2)).write.parquet(f"{base}/in/{name}")
        folders[f"{base}/in/{name}"] = source.schema
        files = max(files, len(spark.read.schema(source.schema).parquet(f"{base}/in/{name}").inputFiles()))
    state = CostState(spark, f"{base}/table")
    # Two micro-batches, each of half of a source's files.
    stream_costs(spark, folders, state, f"{base}/checkpoint", files_at_once=(files + 1) // 2).awaitTermination()
    return state.curve(i.budget, i.schedule)


def sketched_profile(spark, sf_dir):
    return sketches.sketched_profile(sketches.project_sketches(_inputs(spark, sf_dir).cost_sources()))


def sketched_quantiles(spark, sf_dir):
    """Quantiles from sketches, with whether their exact ranks keep twice the bound that holds in 99 % of cases."""
    sources = _inputs(spark, sf_dir).cost_sources()
    found = sketches.quantile_errors(sources, sketches.sketched_quantiles(sketches.cost_sketches(sources)))
    kept = sketches.within(F.col("quantile"), F.col("rank_below"), F.col("rank_to"), 2 * sketches.rank_error(sketches.K_ITEMS))
    return found.select("source", "STAGE", "quantile", "items", kept.alias("within_bound"))


def control_cube(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return summaries.control_cube(_sources(i), act.actual_value(_sources(i), i.budget, i.schedule))


def shortfall_episodes(spark, sf_dir):
    i = _planned_inputs(spark, sf_dir)
    return summaries.shortfall_episodes(act.actual_value(_sources(i), i.budget, i.schedule))


def timeline_episodes(spark, sf_dir):
    return summaries.timeline_episodes(actual_value(spark, sf_dir), q.timeline_issue())


def planned_without_null_projects(spark, sf_dir):
    """P5: the planned curve of budget and schedule rows of which some have no project."""
    i = _inputs(spark, sf_dir)
    none = F.lit(None).cast("string")
    budget = i.budget.unionByName(i.budget.withColumn("PROJECT_NUMBER", none))
    schedule = i.schedule.unionByName(i.schedule.withColumn("PROJECTID", none))
    return pl.planned_value(budget, schedule, i.norm_curve)


def combined_from_numeric_keys(spark, sf_dir):
    """P10: the combined table of curves whose project is a number."""
    _, c = _curves(spark, sf_dir)
    numeric = [df.withColumn("PROJECT_NUMBER", F.col("PROJECT_NUMBER").cast("long")) for df in (c.actual, c.planned, c.forecast)]
    return combined_curves_of(*numeric)


def _table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _until_exit(spark: SparkSession, table: str) -> DataFrame:
    """A table of this run; its files go when the driver's JVM ends."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path(about["Location"])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.table(table)


def staged_curves(spark, sf_dir):
    """The four stages written as tables; the rows of the combined table."""
    names = {k: _table(f"staged_{k}") for k in ("actual", "planned", "forecast", "combined")}
    run_curves(spark, _planned_inputs(spark, sf_dir), AS_OF, tables=names)
    tables = {k: _until_exit(spark, t) for k, t in names.items()}
    return tables["combined"].select(*COMBINED_COLUMNS)


def backed_up_sources(spark, sf_dir):
    """Rows of the backups of three stored source tables, taken before the tables change."""
    counts = None
    for name, source in _inputs(spark, sf_dir).cost_sources().items():
        table = _table(name)
        write_table(source, table)
        backup = backup_table(spark, table)
        write_table(spark.table(table).limit(0), table)
        _until_exit(spark, table)
        rows = _until_exit(spark, backup)
        found = rows.agg(F.lit(name).alias("source"), F.count("*").alias("row_count"),
                         F.sum(act.cost_amounts(rows).cast("decimal(38,10)")).alias("total"))
        counts = found if counts is None else counts.unionByName(found)
    return counts


def refreshed_months(spark, sf_dir):
    """A table of all invoices by month, refreshed to the last two years with costs of one month corrected."""
    invoices = _inputs(spark, sf_dir).invoice
    table = _table("invoices")
    refresh_months(spark, table, invoices, as_of=AS_OF, years=4)
    corrected = invoices.withColumn("ACTUALS_COST", F.when(
        F.date_format("INVOICE_DATE", "yyyy-MM") == "2000-05", F.col("ACTUALS_COST") + 1).otherwise(F.col("ACTUALS_COST")).cast(
            invoices.schema["ACTUALS_COST"].dataType))
    refresh_months(spark, table, corrected, as_of=AS_OF, years=2)
    return _until_exit(spark, table)


QUERIES: dict[str, Query] = {
    "actuals_union": actuals_union,
    "budget_rollup": budget_rollup,
    "actuals_enriched": actuals_enriched,
    "actuals_net": actuals_net,
    "actual_value": actual_value,
    "norm_curve": norm_curve,
    "planned_inputs": planned_inputs,
    "planned_daily": planned_daily,
    "planned_value": planned_value,
    "planned_value_by_day": planned_value_by_day,
    "actuals_summary": actuals_summary,
    "last_cumulative": last_cumulative,
    "future_weights": future_weights,
    "forecast_value": forecast_value,
    "combined_curves": combined_curves,
    "combined_preview": combined_preview,
    "recent_refresh": recent_refresh,
    "source_counts": source_counts,
    "source_profile": source_profile,
    "completeness_check": completeness_check,
    "continuity_check": continuity_check,
    "monotone_violations": monotone_violations,
    "planned_vs_budget": planned_vs_budget,
    "forecast_continuity": forecast_continuity,
    "missing_keys": missing_keys,
    "control_totals": control_totals,
    "freshness": freshness,
    "quality_score": quality_score,
    "budget_alignment": budget_alignment,
    "timeline_check": timeline_check,
}

#: Operators beyond the batch job.
ADDED: dict[str, Query] = {
    "costs_by_schedule": costs_by_schedule,
    "schedule_row_totals": schedule_row_totals,
    "curve_as_of": curve_as_of,
    "late_invoices": late_invoices,
    "streamed_actual_value": streamed_actual_value,
    "sketched_profile": sketched_profile,
    "sketched_quantiles": sketched_quantiles,
    "control_cube": control_cube,
    "shortfall_episodes": shortfall_episodes,
    "timeline_episodes": timeline_episodes,
    "planned_without_null_projects": planned_without_null_projects,
    "combined_from_numeric_keys": combined_from_numeric_keys,
    "staged_curves": staged_curves,
    "backed_up_sources": backed_up_sources,
    "refreshed_months": refreshed_months,
}


def reported(fn: Query) -> Query:
    """Wrap a query so exact decimals are reported as doubles."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_report(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: reported(fn) for name, fn in (QUERIES | ADDED).items()}
