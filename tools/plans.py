"""Print the physical plans of the four stages over stored inputs.

Usage: python tools/plans.py [sf_dir] [--full]

The inputs are derived from the fixture once and written as parquet tables,
and the stages are planned over those tables with AQE and broadcasts off, so
the printed plans show the large-scale shape (exchanges, pushed filters,
read schemas). Writes into a fresh folder under /tmp.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costcurves.operators.actuals import actual_value  # noqa: E402
from costcurves.operators.combine import combined_curves  # noqa: E402
from costcurves.operators.forecast import forecast_value  # noqa: E402
from costcurves.operators.planned import planned_value  # noqa: E402
from costcurves.plans.jobs import run_curves  # noqa: E402
from costcurves.session import local_session  # noqa: E402
from costcurves.sources.fixtures import AS_OF, fixture_inputs  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    full = "--full" in sys.argv
    scratch = tempfile.mkdtemp(prefix="costcurves-plans-")
    spark = local_session(extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    inputs = fixture_inputs(spark, sf_dir)
    t = {}
    for name in ("invoice", "pay_app", "pay_req", "budget", "schedule", "norm_curve"):
        path = os.path.join(scratch, name)
        getattr(inputs, name).write.parquet(path)
        t[name] = spark.read.parquet(path)
    run_curves(spark, inputs, as_of=AS_OF)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    stages = {
        "actual_value": actual_value([t["invoice"], t["pay_app"], t["pay_req"]], t["budget"], t["schedule"]),
        "planned_value": planned_value(t["budget"], t["schedule"], t["norm_curve"]),
        "forecast_value (bucketed stage tables)": forecast_value(
            spark.table("PLANNEDVALUE"), spark.table("ACTUALVALUE"), AS_OF),
        "combined_curves (stage tables)": combined_curves(
            spark.table("ACTUALVALUE"), spark.table("PLANNEDVALUE"), spark.table("FORECASTVALUE")),
    }
    for name, df in stages.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}: shuffles {len(re.findall('Exchange hashpartitioning', plan))}, "
              f"broadcasts {len(re.findall('BroadcastExchange', plan))}, "
              f"scans {len(re.findall('FileScan', plan))}, "
              f"partial aggregates {len(re.findall('partial_', plan)) > 0}")
        if full:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
