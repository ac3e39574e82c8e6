"""Command line: run the stages against catalog tables.

    python -m costcurves all --as-of 2025-06-30
    python -m costcurves actual
    python -m costcurves forecast --as-of 2025-06-30
    python -m costcurves quality --as-of 2025-06-30 --output QUALITY_SCORE

Each stage reads its inputs from the catalog (the six source tables, or the
curve tables written by earlier stages) and overwrites its output table.
The session comes from ``SparkSession.builder.getOrCreate()``, i.e. from the
cluster's configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import jobs
from .schema import ACTUAL_TABLE, COMBINED_TABLE, FORECAST_TABLE, PLANNED_TABLE
from .sources.sinks import write_table
from .sources.tables import DEFAULT_TABLES, CostInputs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="costcurves", description=__doc__.split("\n\n")[0])
    p.add_argument("stage", choices=["actual", "planned", "forecast", "combined", "all", "quality"])
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                   help="forecast cut-off and freshness date (default: today)")
    p.add_argument("--buckets", type=int, default=None,
                   help="buckets of the planned and forecast tables (default: spark.sql.shuffle.partitions)")
    p.add_argument("--planned-method", choices=["bucket", "daily"], default="bucket")
    for field, table in DEFAULT_TABLES.items():
        p.add_argument(f"--{field.replace('_', '-')}-table", default=table, dest=f"src_{field}")
    for name, table in [("actual", ACTUAL_TABLE), ("planned", PLANNED_TABLE),
                        ("forecast", FORECAST_TABLE), ("combined", COMBINED_TABLE)]:
        p.add_argument(f"--{name}-output", default=table, dest=f"out_{name}")
    p.add_argument("--output", default="QUALITY_SCORE", help="table for the quality score")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("costcurves").getOrCreate()
    names = {field: getattr(args, f"src_{field}") for field in DEFAULT_TABLES}
    out = {k: getattr(args, f"out_{k}") for k in ("actual", "planned", "forecast", "combined")}

    def inputs() -> CostInputs:
        return CostInputs.from_catalog(spark, names)

    if args.stage == "all":
        jobs.run_curves(spark, inputs(), args.as_of, tables=out, planned_method=args.planned_method,
                        buckets=args.buckets).show()
    elif args.stage == "actual":
        jobs.run_actual_stage(spark, inputs(), out["actual"])
    elif args.stage == "planned":
        jobs.run_planned_stage(spark, inputs(), out["planned"], args.planned_method, args.buckets)
    elif args.stage == "forecast":
        jobs.run_forecast_stage(spark, args.as_of, out["actual"], out["planned"], out["forecast"],
                                buckets=args.buckets)
    elif args.stage == "combined":
        jobs.run_combined_stage(spark, out["actual"], out["planned"], out["forecast"],
                                out["combined"]).show()
    else:
        curves = jobs.Curves(spark.table(out["actual"]), spark.table(out["planned"]),
                             spark.table(out["forecast"]), spark.table(out["combined"]))
        write_table(jobs.quality_score(inputs(), args.as_of, curves=curves), args.output)
        spark.table(args.output).show(truncate=False)


if __name__ == "__main__":
    main()
