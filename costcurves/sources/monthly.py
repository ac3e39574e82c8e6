"""Refresh of a table month by month: months that did not change keep their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .sinks import recent_rows

MONTH = "MONTH"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def with_month(rows: DataFrame, date_col: str) -> DataFrame:
    return rows.withColumn(MONTH, F.date_format(F.col(date_col), "yyyy-MM"))


def _prints(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per month: number of rows and an order-free sum of their hashes, which tells multisets of rows apart."""
    mark = F.xxhash64(*[F.col(c) for c in columns], F.lit(1)).cast("decimal(38,0)")
    again = F.xxhash64(F.lit(2), *[F.col(c) for c in columns]).cast("decimal(38,0)")
    return rows.groupBy(MONTH).agg(F.count("*").alias("n"), F.sum(mark).alias("a"), F.sum(again).alias("b"))


def refresh_months(spark: SparkSession, target: str, source: DataFrame, date_col: str = "INVOICE_DATE", as_of=None,
                   years: int = 2) -> dict[str, list[str]]:
    """Make ``target``, a table partitioned by month, hold the last ``years`` years of ``source``.

    Months whose rows are the same stay as they are; changed ones are replaced as whole folders at the commit of one write; months that
    the window has left are dropped after it. A failure before leaves the old table. ``source`` may read ``target``.
    Returns the months written and dropped; all months that the driver sees are those of the window and of the table.
    """
    rows = with_month(recent_rows(source, date_col, as_of, years), date_col)
    if not spark.catalog.tableExists(target):
        rows.repartition(MONTH, F.rand(7)).write.format("parquet").partitionBy(MONTH).saveAsTable(target)
        return {"written": sorted(r[0] for r in rows.select(MONTH).distinct().collect()), "dropped": []}
    old = spark.table(target)
    columns = [c for c in old.columns if c != MONTH]
    rows = rows.select(*columns, MONTH)
    both = _prints(rows, columns).alias("x").join(_prints(old, columns).alias("y"), MONTH, "full")
    same = (F.col("x.n") == F.col("y.n")) & (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b"))
    state = both.select(MONTH, F.col("x.n").isNull().alias("gone"), F.coalesce(same, F.lit(False)).alias("same")).collect()
    written = sorted(r[MONTH] for r in state if not r["gone"] and not r["same"])
    dropped = sorted(r[MONTH] for r in state if r["gone"])
    if written:
        # Staged apart: the source may read the table that is being written.
        folder = shared_folder(spark, "refresh")
        rows.filter(F.col(MONTH).isin(written)).write.parquet(folder)
        before = spark.conf.get(OVERWRITE, None)
        spark.conf.set(OVERWRITE, "dynamic")
        try:
            spark.read.schema(rows.schema).parquet(folder).write.insertInto(target, overwrite=True)
        finally:
            if before is None:
                spark.conf.unset(OVERWRITE)
            else:
                spark.conf.set(OVERWRITE, before)
    for month in dropped:
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
    return {"written": written, "dropped": dropped}
