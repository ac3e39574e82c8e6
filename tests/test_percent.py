"""Percent keys against Python's own rounding, by brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from costcurves.functions.percent import (
    TIE_PERCENT,
    curve_percent_key,
    percent_first_days,
    schedule_percent_key,
)

MAX_D = 420


def _py_key(i: int, d: int) -> int:
    return int(round(round(i / d, 2) * 100))


def _pairs(spark, max_d):
    return (spark.range(1, max_d + 1).withColumnRenamed("id", "d")
            .select("d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("d") - 1)).alias("i")))


def test_tie_table_shape():
    assert len(TIE_PERCENT) == 100
    assert all(abs(v - (2 * j + 1) / 2) <= 0.5 for j, v in enumerate(TIE_PERCENT))


def test_schedule_key_matches_python_round(spark):
    rows = (_pairs(spark, MAX_D)
            .select("d", "i", schedule_percent_key(F.col("i"), F.col("d")).alias("k"))
            .collect())
    assert len(rows) == MAX_D * (MAX_D + 1) // 2
    bad = [(r.i, r.d, r.k) for r in rows if r.k != _py_key(r.i, r.d)]
    assert bad == []


def test_first_day_matches_brute_force(spark):
    expected = {}
    for d in range(1, MAX_D + 1):
        for i in range(d):
            expected.setdefault((d, _py_key(i, d)), i)
    durations = spark.range(1, MAX_D + 1).withColumnRenamed("id", "d")
    got = durations.select("d", F.inline(percent_first_days(F.col("d")))).collect()
    assert {(r.d, r.PCT_KEY): r.DAY for r in got} == expected


def test_curve_key_is_numpy_rounding(spark):
    import numpy as np

    vals = [k / 100 for k in range(101)] + [0.005, 0.015, 0.125, 0.995, 0.994999, 0.33333]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.k for r in df.select(curve_percent_key(F.col("p")).alias("k")).collect()]
    assert got == [int(round(float(np.round(v, 2)) * 100)) for v in vals]
