"""Hot-key probe: one key holds a third of all cost rows.

Usage: python tools/skew_probe.py [sf_dir]

Derives (with Spark, into a fresh folder under /tmp) a copy of lineitem
where every third order's lines belong to one supplier, return flag and
part, i.e. to one (project, stage, sub-stage) key; runs planned_value, the
row-level actuals_enriched, and actual_value with invoice dates spread over the
seconds of their day over it with the event log on, and prints per-stage
task time and record counts (max vs median).
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from costcurves.operators.actuals import actual_value  # noqa: E402
from costcurves.plans.registry import queries  # noqa: E402
from costcurves.session import local_session  # noqa: E402
from costcurves.sources.fixtures import fixture_inputs  # noqa: E402

QUERIES = ["actual_value", "planned_value", "actuals_enriched"]


def _actual_by_second(spark, sf_dir):
    """The actual curve over invoice dates with a second of the day from the row's cost."""
    i = fixture_inputs(spark, sf_dir)
    second = F.make_dt_interval(secs=F.pmod(F.xxhash64("ACTUALS_COST"), F.lit(86_400)).cast("decimal(18,6)"))
    timed = [df.withColumn("INVOICE_DATE", F.col("INVOICE_DATE") + second) for df in (i.invoice, i.pay_app, i.pay_req)]
    return actual_value(timed, i.budget, i.schedule)


def _events(run: str) -> list[dict]:
    import zstandard

    out = []
    for f in sorted(glob.glob(os.path.join(run, "**", "events_*"), recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        out += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return out


def main() -> None:
    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    run = tempfile.mkdtemp(prefix="costcurves-skew-")
    spark = local_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": run, "spark.driver.memory": "16g"})
    hot_dir = os.path.join(run, "hot")
    hot = F.pmod(F.col("l_orderkey"), F.lit(3)) == 0
    (spark.read.parquet(f"{src}/lineitem.parquet")
     .withColumn("l_suppkey", F.when(hot, F.lit(42)).otherwise(F.col("l_suppkey")))
     .withColumn("l_returnflag", F.when(hot, F.lit("A")).otherwise(F.col("l_returnflag")))
     .withColumn("l_partkey", F.when(hot, F.lit(7)).otherwise(F.col("l_partkey")))
     .repartition(8).write.parquet(f"{hot_dir}/lineitem.parquet"))
    spark.read.parquet(f"{src}/part.parquet").write.parquet(f"{hot_dir}/part.parquet")
    q = queries() | {"actual_value": _actual_by_second}
    for name in QUERIES:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        q[name](spark, hot_dir).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - t0:.2f} s")
    spark.stop()

    group_of, tasks = {}, defaultdict(list)
    events = _events(run)
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                group_of[s] = e.get("Properties", {}).get("spark.jobGroup.id")
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Info"):
            info, m = e["Task Info"], e.get("Task Metrics") or {}
            records = (m.get("Input Metrics", {}).get("Records Read", 0)
                       + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            tasks[e["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], records))
    for stage in sorted(tasks):
        ms = [t for t, _ in tasks[stage]]
        rec = [r for _, r in tasks[stage]]
        if group_of.get(stage) in QUERIES and len(ms) > 1 and max(ms) >= 150:
            print(f"{group_of[stage]:17s} stage {stage:4d} tasks {len(ms):3d}  "
                  f"ms max {max(ms):5d} median {int(statistics.median(ms)):5d}  "
                  f"records max {max(rec):7d} median {int(statistics.median(rec)):7d}")


if __name__ == "__main__":
    main()
