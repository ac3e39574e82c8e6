"""Test-table adapter: the six cost inputs derived from lineitem + part.

The upstream project ships no data, so the supplied TPC-H-like tables are
mapped onto the input schemas (see FIXTURES.md section 2). Every table below
is a Spark derivation of lineitem/part, so its size grows with the scale
factor; nothing is synthesized on the driver.

Mapping: key = (l_suppkey as text, l_returnflag, p_type), fund = l_linestatus,
date = day of l_shipdate, cost = l_extendedprice as decimal(18,2).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import CostInputs

# Fixed values of the adapter (FIXTURES.md section 2).
FINE_COST = "decimal(18,4)"              # costs are finer than cents
FINE_NORM = "decimal(18,10)"             # curve values are finer than six decimals
AS_OF = _dt.date(2001, 3, 1)            # "today" of the fixture
BUDGET_PCT_BASE = 80                     # budget = cost * (80 + (sk*7) % 50) %
BUDGET_PCT_MULT = 7
BUDGET_PCT_SPAN = 50
NULL_BUDGET_MOD = 3                      # sk % 10 = 3 -> budget NULL
NO_BUDGET_MOD = 7                        # sk % 10 = 7 -> no budget rows
NO_ACTUALS_MOD = 1                       # sk % 10 = 1 and stage 'N' -> no actuals
SCHEDULE_DAYS_BASE = 60                  # n = 60 + (sk*37 + ascii(stage)*11) % 500
SCHEDULE_SK_MULT = 37
SCHEDULE_STAGE_MULT = 11
SCHEDULE_SPAN = 500
EMPTY_SCHEDULE_MOD = 9                   # sk % 10 = 9 -> start = end
NULL_END_MOD = 8                         # sk % 10 = 8 and stage 'N' -> end NULL
REPEAT_SCHEDULE_MOD = 5                  # sk % 10 = 5 and stage 'A' -> second row, start + 5 days
REPEAT_SHIFT_DAYS = 5
SHORT_END_MOD = 6                        # sk % 10 = 6 -> schedule ends 40 days before the last cost
SHORT_END_DAYS = 40
LATE_ACTUALS_MOD = 4                     # sk % 10 = 4 -> actuals after AS_OF are kept
PAY_APP_LAG_DAYS = 30                    # pay_app has nothing in the last 30 days before AS_OF
NO_KEY_MOD = 0                           # sk % 10 = 0, line 3: no project (stage N), no date (stage A)
CREDIT_MOD = 2                           # sk % 10 = 2, stage A, line 2: credit of 1.5 times the cost
BAD_COST_MOD = 1                         # sk % 10 = 1, line 5: cost text 'n/a'
CURVE_MISSING = ("SMALL", 37)            # curve point absent
CURVE_NULL = ("PROMO", 50)               # curve point present with NULL value
CURVE_OFF_GRID = 0.002                   # odd points lie so far above k / 100
CURVE_SECOND = 0.004                     # every tenth point has a second one so far above, with value 0.9


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs with their type; ``day`` is a date. Days and costs are computed before the join: its rows are shorter so."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_partkey",
        F.col("l_suppkey").alias("sk"),
        F.col("l_returnflag").alias("stage"),
        F.col("l_linestatus").alias("fund"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_linenumber").alias("ln"),
        (F.col("l_extendedprice").cast("decimal(16,2)") + F.col("l_linenumber").cast("int") * F.lit(Decimal("0.0013"))
         ).cast(FINE_COST).alias("cost"),
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type")
    # part is a dimension: the planner / AQE chooses broadcast by its measured size.
    return li.join(part, li.l_partkey == part.p_partkey).select("sk", "stage", F.col("p_type").alias("sub"), "fund", "day", "ln", "cost")


def _mod10(c: str, m: int) -> Column:
    return F.pmod(F.col(c), F.lit(10)) == m


def _cost_source(df: DataFrame, cost: Column, project: Column | None = None, day: Column | None = None) -> DataFrame:
    return df.select(
        (F.col("project") if project is None else project).alias("PROJECTID"),
        F.col("stage").alias("STAGEPHASE_CODE"),
        F.col("sub").alias("SUBSTAGEACTIVITY_CODE"),
        (F.col("d") if day is None else day).alias("INVOICE_DATE"),
        cost.alias("ACTUALS_COST"),
    )


def fixture_inputs(spark: SparkSession, sf_dir: str, store: Callable[[DataFrame, str], DataFrame] | None = None) -> CostInputs:
    """The inputs as views over the tables. ``store`` writes a table under a name and reads it back: the costs with their
    type, which all sources share, and their sums per key and fund, which budget and schedule share. Without it each
    reading of a source, of budget or of schedule joins lineitem and part again."""
    base = _base(spark, sf_dir)
    if store is not None:
        base = store(base, "costs")
    base = base.withColumns({"project": F.col("sk").cast("string"), "d": F.col("day").cast("timestamp_ntz")})
    as_of = F.lit(AS_OF.isoformat()).cast("timestamp_ntz")

    actual_rows = base.filter(
        ((F.col("d") <= as_of) | _mod10("sk", LATE_ACTUALS_MOD))
        & ~(_mod10("sk", NO_ACTUALS_MOD) & (F.col("stage") == "N")))
    no_key = _mod10("sk", NO_KEY_MOD) & (F.col("ln") == 3)
    invoice = _cost_source(
        actual_rows.filter(F.col("ln") <= 3), F.col("cost"),
        F.when(~(no_key & (F.col("stage") == "N")), F.col("project")),
        F.when(~(no_key & (F.col("stage") == "A")), F.col("d")))
    # Costs of this source come as text, some of it no number.
    text_cost = F.when(_mod10("sk", BAD_COST_MOD) & (F.col("ln") == 5), F.lit("n/a")).otherwise(
        F.col("cost").cast("string"))
    pay_app = _cost_source(
        actual_rows.filter((F.col("ln") >= 4) & (F.col("d") <= as_of - F.make_dt_interval(days=F.lit(PAY_APP_LAG_DAYS)))),
        text_cost)
    reversed_cost = (F.col("ln") == 1) & (F.col("stage") == "R")
    credit = (F.col("ln") == 2) & (F.col("stage") == "A") & _mod10("sk", CREDIT_MOD)
    pay_req = _cost_source(
        actual_rows.filter(reversed_cost | credit),
        F.when(reversed_cost, -F.col("cost")).otherwise(F.col("cost") * F.lit(Decimal("-1.5"))).cast(FINE_COST))

    # Budget and schedule are views over these sums.
    per_fund = base.groupBy("sk", "stage", "sub", "fund").agg(
        F.sum("cost").alias("total"), F.max("day").alias("last_day"))
    if store is not None:
        per_fund = store(per_fund, "sums")
    per_fund = per_fund.withColumns({"project": F.col("sk").cast("string"), "last_day": F.col("last_day").cast("timestamp_ntz")})

    budget_pct = F.lit(BUDGET_PCT_BASE) + F.pmod(F.col("sk") * BUDGET_PCT_MULT, F.lit(BUDGET_PCT_SPAN))
    budget = (
        per_fund.filter(~_mod10("sk", NO_BUDGET_MOD))
        .select(
            F.col("project").alias("PROJECT_NUMBER"),
            F.col("stage").alias("STAGE"),
            F.col("sub").alias("SUB_STAGE"),
            F.col("fund").alias("FUND"),
            F.when(_mod10("sk", NULL_BUDGET_MOD), F.lit(None))
            .otherwise(F.col("total") * budget_pct * F.lit(Decimal("0.01")))
            .cast("decimal(20,4)").alias("BUDGET_CURRENT_APPROVED"),
        )
    )

    span = F.when(_mod10("sk", EMPTY_SCHEDULE_MOD), F.lit(0)).otherwise(
        F.lit(SCHEDULE_DAYS_BASE)
        + F.pmod(F.col("sk") * SCHEDULE_SK_MULT + F.ascii("stage") * SCHEDULE_STAGE_MULT,
                 F.lit(SCHEDULE_SPAN)))
    per_key = (
        per_fund.groupBy("sk", "project", "stage", "sub")
        .agg(F.max("last_day").alias("e"))
        .withColumn("e", F.when(_mod10("sk", SHORT_END_MOD), F.col("e") - F.make_dt_interval(
            days=F.lit(SHORT_END_DAYS))).otherwise(F.col("e")))
        .withColumn("s", F.col("e") - F.make_dt_interval(days=span))
    )
    null_end = _mod10("sk", NULL_END_MOD) & (F.col("stage") == "N")
    first_rows = per_key.select(
        F.col("project").alias("PROJECTID"),
        F.col("stage").alias("STAGECODE"),
        F.col("sub").alias("STAGESUBSTAGECODE"),
        F.col("s").alias("CURRENTSTART"),
        F.when(null_end, F.lit(None)).otherwise(F.col("e")).cast("timestamp_ntz").alias("CURRENTEND"),
    )
    repeated = per_key.filter(_mod10("sk", REPEAT_SCHEDULE_MOD) & (F.col("stage") == "A")).select(
        F.col("project").alias("PROJECTID"),
        F.col("stage").alias("STAGECODE"),
        F.col("sub").alias("STAGESUBSTAGECODE"),
        (F.col("s") + F.make_dt_interval(days=F.lit(REPEAT_SHIFT_DAYS))).alias("CURRENTSTART"),
        F.col("e").alias("CURRENTEND"),
    )
    # Schedule dates come as text.
    schedule = first_rows.unionByName(repeated).withColumns(
        {c: F.col(c).cast("string") for c in ("CURRENTSTART", "CURRENTEND")})

    k = F.col("k")
    types = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_type").distinct()
    raw_value = ((k * k * (F.lit(300) - k * 2)).cast("decimal(9,0)") * F.lit(Decimal("0.000001"))
                 + k * F.lit(Decimal("0.0000000123"))).cast(FINE_NORM)
    off_grid = F.when(k % 2 == 1, F.lit(CURVE_OFF_GRID)).otherwise(F.lit(0.0))
    points = (
        types.select("p_type", F.explode(F.sequence(F.lit(0), F.lit(100))).alias("k"))
        .filter(~((F.col("p_type") == CURVE_MISSING[0]) & (k == CURVE_MISSING[1])))
    )
    label = F.concat(F.col("p_type"), F.lit(" - phase")).alias("SUBSTAGES")
    norm_curve = points.select(
        label, (k / F.lit(100) + off_grid).cast("double").alias("PERCENT_COMPLETIONTIME"),
        F.when((F.col("p_type") == CURVE_NULL[0]) & (k == CURVE_NULL[1]), F.lit(None))
        .otherwise(raw_value).cast(FINE_NORM).alias("NORM_PERCENT_CUMSPENT"),
    ).unionByName(points.filter(k % 10 == 0).select(
        label, (k / F.lit(100) + F.lit(CURVE_SECOND)).cast("double").alias("PERCENT_COMPLETIONTIME"),
        F.lit(Decimal("0.9")).cast(FINE_NORM).alias("NORM_PERCENT_CUMSPENT")))

    return CostInputs(invoice=invoice, pay_app=pay_app, pay_req=pay_req,
                      budget=budget, schedule=schedule, norm_curve=norm_curve)
