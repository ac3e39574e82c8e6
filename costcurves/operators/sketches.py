"""Profiles of the cost sources from mergeable sketches.

A sketch table holds one row a source and day, and is small beside its source. Days are added to it as
they come, and any range of days, sources or curves is profiled by merging rows, without the sources.

* Distinct projects: theta sketches with 2^LG_ENTRIES nominal entries. They are exact up to so many projects and beyond
  that have a relative standard error of 2^(-LG_ENTRIES / 2), 1.6 % here. Unions, intersections and differences
  of sets can be estimated from them.
* Cost quantiles: KLL sketches of K_ITEMS. The rank of a reported quantile is within ``rank_error(K_ITEMS)``, 1.0 %
  here, of the one asked for, in 99 % of cases.

An exact count of distinct projects beside other aggregates copies every row once for each distinct column; one
sketch is a plain partial aggregate of the day's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import to_timestamp_strict
from ..sources.tables import select_cost_source
from .actuals import cost_amounts

LG_ENTRIES = 12
K_ITEMS = 400
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def rank_error(k: int) -> float:
    """Normalised rank error of a KLL sketch of k items at 99 % confidence."""
    return 2.296 / k**0.9021


def _stacked(sources: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in sources.items():
        s = select_cost_source(df)
        parts.append(s.select(F.lit(name).alias("source"), "PROJECT_NUMBER", "STAGE",
                              to_timestamp_strict(s, "INVOICE_DATE").alias("INVOICE_DATE"),
                              cost_amounts(s).cast("double").alias("ACTUALS_COST")))
    return reduce(DataFrame.unionByName, parts)


def project_sketches(sources: dict[str, DataFrame], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """(source, day, row_count, min_date, max_date, projects): one row a source and day; null dates are a day of their own."""
    return _stacked(sources).groupBy("source", F.col("INVOICE_DATE").cast("date").alias("day")).agg(
        F.count("*").alias("row_count"), F.min("INVOICE_DATE").alias("min_date"), F.max("INVOICE_DATE").alias("max_date"),
        F.theta_sketch_agg("PROJECT_NUMBER", lg_entries).alias("projects"))


def sketched_profile(sketches: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """A8 from sketches: (source, row_count, min_date, max_date, distinct_projects, exact, missing_projects).

    ``exact``: the count is no estimate. ``missing_projects``: projects of other sources that this one lacks (the
    difference of its set and the union of all).
    """
    every = sketches.agg(F.theta_union_agg("projects", lg_entries).alias("every")).scalar()
    rows = sketches.groupBy("source").agg(
        F.sum("row_count").alias("row_count"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"),
        F.theta_union_agg("projects", lg_entries).alias("projects")).withColumn("every", every)
    count = F.theta_sketch_estimate("projects")
    return rows.select("source", "row_count", "min_date", "max_date", count.alias("distinct_projects"),
                       (F.theta_sketch_estimate("every") < 2**lg_entries).alias("exact"),
                       F.theta_sketch_estimate(F.theta_difference("every", "projects")).alias("missing_projects"))


def cost_sketches(sources: dict[str, DataFrame], k: int = K_ITEMS) -> DataFrame:
    """(source, STAGE, day, cost_sketch): one row a source, stage and day."""
    return _stacked(sources).groupBy("source", "STAGE", F.col("INVOICE_DATE").cast("date").alias("day")).agg(
        F.kll_sketch_agg_double("ACTUALS_COST", k).alias("cost_sketch"))


def sketched_quantiles(sketches: DataFrame, quantiles: tuple[float, ...] = QUANTILES, k: int = K_ITEMS) -> DataFrame:
    """(source, STAGE, quantile, items, cost): the cost quantiles of each source and stage, from merged sketches."""
    rows = sketches.groupBy("source", "STAGE").agg(F.kll_merge_agg_double("cost_sketch", k).alias("merged"))
    found = [F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("merged", F.lit(float(q))).alias("cost"))
             for q in quantiles]
    rows = rows.select("source", "STAGE", F.kll_sketch_get_n_double("merged").alias("items"), F.explode(F.array(*found)).alias("q"))
    return rows.select("source", "STAGE", "q.quantile", "items", "q.cost")


def quantile_errors(sources: dict[str, DataFrame], found: DataFrame) -> DataFrame:
    """``found`` with the share of costs below and up to each reported cost: the ranks that the quantile may have."""
    groups = found.groupBy("source", "STAGE").agg(F.collect_list(F.struct("quantile", "items", "cost")).alias("_ASKED"))
    rows = _stacked(sources).join(groups, ["source", "STAGE"])
    rows = rows.select("source", "STAGE", "ACTUALS_COST", F.explode("_ASKED").alias("_A"))
    share = lambda c: F.avg(c.cast("double"))
    return rows.groupBy("source", "STAGE", "_A.quantile", "_A.items", "_A.cost").agg(
        share(F.col("ACTUALS_COST") < F.col("_A.cost")).alias("rank_below"),
        share(F.col("ACTUALS_COST") <= F.col("_A.cost")).alias("rank_to"))


def within(quantile: Column, below: Column, to: Column, error: float) -> Column:
    return (quantile >= below - error) & (quantile <= to + error)
