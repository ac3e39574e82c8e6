"""Sinks: overwrite a table, snapshot it, refresh a recent window, preview."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_of_date


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
                bucket_by: list[str] | None = None, buckets: int | None = None,
                partition_by: list[str] | None = None, dealt: bool = False) -> None:
    """Replace (or append to) a catalog table with ``df``.

    An overwrite writes a staging table, once, and swaps names when it is whole, so a failed write leaves the old
    table as it was and readers never find none for longer than the renames take. A table at a fixed ``path`` is
    overwritten in place.

    With ``bucket_by`` the table is hash-bucketed on those columns (``buckets``
    defaults to ``spark.sql.shuffle.partitions``). The rows are first
    repartitioned with the same hash, so each task writes one file, and later
    joins, aggregates and windows on those columns read co-located buckets
    without a shuffle: for keys of bounded size only. ``dealt``: the rows lie in
    these partitions already and are written as they lie. ``partition_by`` lays the
    table out in one folder per value of low-cardinality columns, so filters on
    them prune whole folders.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staging = _beside(name, "staging")
    writer = ((df if dealt else df.repartition(n, *bucket_by)).write.bucketBy(n, *bucket_by) if bucket_by else df.write).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None or mode != "overwrite":
        writer = writer if path is None else writer.option("path", path)
        writer.mode(mode).saveAsTable(name)
        return
    try:
        writer.mode("errorifexists").saveAsTable(staging)
        _take_name(spark, staging, name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise


def _beside(name: str, kind: str) -> str:
    return f"{name}_{kind}_{uuid.uuid4().hex[:12]}"


def _rename(spark: SparkSession, name: str, to: str) -> None:
    """Rename a table; its partitions follow its folder."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {to}").collect()}
    if "# Partition Information" not in about:
        return
    for row in spark.sql(f"SHOW PARTITIONS {to}").collect():
        spec = [part.split("=", 1) for part in row["partition"].split("/")]
        values = ", ".join("{} = '{}'".format(k, unquote(v).replace("'", "\\'")) for k, v in spec)
        spark.sql(f"ALTER TABLE {to} PARTITION ({values}) SET LOCATION '{about['Location']}/{row['partition']}'")


def _take_name(spark: SparkSession, staging: str, name: str) -> None:
    """``staging`` becomes the table ``name``; the table that has the name goes when that has succeeded."""
    if not spark.catalog.tableExists(name):
        _rename(spark, staging, name)
        return
    old = _beside(name, "old")
    _rename(spark, name, old)
    try:
        _rename(spark, staging, name)
    except Exception:
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}")
        _rename(spark, old, name)
        raise
    spark.sql(f"DROP TABLE {old}")


def backup_table(spark: SparkSession, name: str, suffix: str = "_BACKUP",
                 mode: str = "errorifexists") -> str:
    """Snapshot ``name`` into ``name + suffix`` (CREATE TABLE ... AS SELECT *)."""
    target = f"{name}{suffix}"
    spark.table(name).write.mode(mode).format("parquet").saveAsTable(target)
    return target


def recent_rows(df: DataFrame, date_col: str = "INVOICE_DATE", as_of=None, years: int = 2) -> DataFrame:
    """Rows dated on or after ``as_of`` minus ``years`` years (inclusive).

    ``add_months`` clamps Feb 29 to Feb 28 like a calendar year subtraction.
    The comparison is a plain column-vs-constant predicate, so it reaches the
    parquet scan as a pushed filter.
    """
    since = F.add_months(as_of_date(as_of), -12 * years).cast("timestamp_ntz")
    return df.filter(F.col(date_col) >= since)


def refresh_table(spark: SparkSession, target: str, source: DataFrame,
                  date_col: str = "INVOICE_DATE", as_of=None, years: int = 2) -> None:
    """Replace the rows of ``target`` with the last ``years`` years of ``source``.

    An existing table keeps its definition (layout, properties); rows are
    matched to its columns by name. They are written once, to a new table of the same
    definition that takes the name when it is whole, so ``source`` may read ``target``, and a failure at any
    point leaves the old table.
    """
    rows = recent_rows(source, date_col, as_of, years)
    if not spark.catalog.tableExists(target):
        write_table(rows, target)
        return
    staging = _beside(target, "staging")
    spark.sql(f"CREATE TABLE {staging} LIKE {target}")
    try:
        kept = [r for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect() if not r["key"].startswith(("spark.sql.", "transient"))]
        if kept:
            pairs = ", ".join("'{}' = '{}'".format(r["key"], r["value"].replace("'", "\\'")) for r in kept)
            spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({pairs})")
        rows.select(*spark.table(target).columns).write.insertInto(staging)
        _take_name(spark, staging, target)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-n (TakeOrderedAndProject)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
