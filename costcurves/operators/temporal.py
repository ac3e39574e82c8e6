"""Joins by time inside a key: the last value known on a date, and the interval that covers it.

Both cut a key's time line into blocks and deal rows by (key, block), so a key that holds a third of all
rows is spread over its blocks. What a block must know of the others is one row a block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import to_timestamp_strict
from ..schema import KEY
from ..sources.tables import select_schedule

#: Days of a bucket of intervals.
BLOCK_DAYS = 32
#: Days of a block of rows. A block's rows are one window partition; its last values one row of the next step, so blocks of
#: keys with few rows should not be as many as these.
ROW_DAYS = 256
#: Each coarser level of schedule buckets is so many times as wide.
FAN = 64
#: Days 1 to 9999-12-31 lie in few buckets of the widest level.
LEVELS = 4


def day_number(ts: Column) -> Column:
    """Days since 1970-01-01, negative before."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))


def block_of(ts: Column, days: int) -> Column:
    return F.floor(day_number(ts) / days).cast("int")


def blocked(rows: DataFrame, keys: list[str], time: str, days: int = ROW_DAYS) -> DataFrame:
    """``rows`` with their ``_BLOCK``, dealt by (key, block); rows with a null key or time drop.

    What follows by these needs no further shuffle of the rows, and plans that read the same columns share this one: the
    filters that a join by key and block would infer on one side are stated here.
    """
    placed = rows.withColumn("_BLOCK", block_of(F.col(time), days))
    for c in (*keys, time, "_BLOCK"):
        placed = placed.filter(F.col(c).isNotNull())
    return placed.repartition(*keys, "_BLOCK")


def carry_forward(rows: DataFrame, keys: list[str], time: str, columns: list[str], order: Column | None = None,
                  block_days: int = ROW_DAYS) -> DataFrame:
    """``rows`` with each of ``columns`` replaced by its last non-null value at or before the row's time.

    ``order`` ranks rows of one time (ascending, nulls first). The last value is carried inside a block of days
    by one window, and from block to block by a window over one row a block. Rows with a null key or time get no
    value from others. ``rows`` is shuffled once, by (key, block), and read again for those with nulls.
    """
    kept = [c for c in rows.columns if c not in columns]
    by = [F.col(time), *([] if order is None else [order])]
    lost = F.col(time).isNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    empty = rows.filter(lost).withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in columns})
    rows = blocked(rows, keys, time, block_days)
    last = F.struct(*by)
    # All columns are read, so that the blocks' ends and the rows come from one shuffle.
    others = [F.count(c) for c in kept if c not in (*keys, time)]
    ends = rows.groupBy(*keys, "_BLOCK").agg(sum(others, F.lit(0)).alias("_READ"), F.max(last).alias("_LAST"), *[
        F.max_by(c, F.when(F.col(c).isNotNull(), last)).alias(c) for c in columns]).filter("_READ >= 0 and _LAST is not null")
    earlier = Window.partitionBy(*keys).orderBy("_BLOCK").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_BLOCK", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_BEFORE_{c}") for c in columns])
    inside = Window.partitionBy(*keys, "_BLOCK").orderBy(*[c.asc() for c in by]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return filled.join(carried, [*keys, "_BLOCK"], "left").select(
        *kept, *[F.coalesce(c, f"_BEFORE_{c}").alias(c) for c in columns]).unionByName(empty.select(*kept, *columns))


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
               columns: list[str], block_days: int = ROW_DAYS) -> DataFrame:
    """Every row of ``left`` with ``columns`` and ``right_time`` of the last ``right`` row of its key at or before its time.

    A left join: null without such a row, and for null keys and times. Of right rows of one key and time the one with
    the greatest values counts. Both sides are stacked and sorted together; neither is joined by its key
    alone.
    """
    clash = {right_time, *columns} & (set(left.columns) - {left_time})
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    # Rows carry their keys and time once. Right rows come before left ones of their time, the greatest last.
    others = [c for c in left.columns if c not in (*keys, left_time)]
    a = left.select(*keys, F.col(left_time).alias("_TIME"), F.struct(F.lit(1).alias("_LEFT"), *others).alias("_ROW"))
    b = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("_TIME"), F.struct(F.col(right_time).alias("_AT"), *columns).alias("_MATCH"))
    both = b.select("*", F.lit(None).cast(a.schema["_ROW"].dataType).alias("_ROW")).unionByName(
        a.select("*", F.lit(None).cast(b.schema["_MATCH"].dataType).alias("_MATCH")))
    order = F.struct(F.col("_ROW").isNotNull(), "_MATCH")
    found = carry_forward(both, keys, "_TIME", ["_MATCH"], order, block_days).filter("_ROW is not null")
    row = [F.col(c) if c in keys else F.col("_TIME").alias(c) if c == left_time else F.col(f"_ROW.{c}") for c in left.columns]
    match = [F.col("_MATCH._AT" if c == right_time else f"_MATCH.{c}").alias(c)
             for c in ([] if right_time == left_time else [right_time]) + columns]
    return found.select(*row, *match)


def running(rows: DataFrame, keys: list[str], time: str, amount: str, total: str, combine: Callable = F.sum) -> DataFrame:
    """``rows`` (one a key and time) with ``total``: ``amount`` combined up to the row's time.

    Two levels: one value a block, and one window inside each block. ``combine`` is F.sum, F.max or F.min. Rows
    that are ``blocked`` already keep their ``_BLOCK`` and are not shuffled.
    """
    kind = rows.schema[amount].dataType
    dealt = "_BLOCK" in rows.columns
    rows = rows if dealt else blocked(rows, keys, time)
    earlier = Window.partitionBy(*keys).orderBy("_LAST").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, "_BLOCK").agg(combine(amount).alias("_SUM"), F.max(time).alias("_LAST")).select(
        *keys, "_BLOCK", combine("_SUM").over(earlier).alias("_BEFORE"))
    inside = Window.partitionBy(*keys, "_BLOCK").orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn(total, combine(amount).over(inside))
    if combine is F.sum:
        both = F.col(total) + F.coalesce("_BEFORE", F.lit(0))
    else:
        both = {F.max: F.greatest, F.min: F.least}[combine](total, "_BEFORE")
    return rows.join(blocks, [*keys, "_BLOCK"]).withColumn(total, both.cast(kind)).drop("_BEFORE", *([] if dealt else ["_BLOCK"]))


def bucketed_intervals(intervals: DataFrame, start: str, end: str, days: int = BLOCK_DAYS, fan: int = FAN) -> DataFrame:
    """``intervals`` with (``_LEVEL``, ``_BUCKET``), one row a bucket of days that the interval touches.

    An interval lies on the finest level where it touches at most ``fan`` + 1 buckets; level l has buckets of
    days * fan^l days. Empty and null intervals are left out.
    """
    rows = intervals.filter(F.col(start) <= F.col(end))
    length = day_number(F.col(end)) - day_number(F.col(start))
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(length < days * fan ** (k + 1), k).otherwise(level)
    rows = rows.withColumn("_LEVEL", level.cast("int"))
    bucket = lambda c: F.floor(day_number(F.col(c)) / width_of(F.col("_LEVEL"), days, fan))
    return rows.withColumn("_BUCKET", F.explode(F.sequence(bucket(start), bucket(end))))


def width_of(level: Column, days: int, fan: int) -> Column:
    return (F.lit(days) * F.pow(F.lit(fan), level)).cast("long")


def covering_join(points: DataFrame, intervals: DataFrame, keys: list[str], time: str, start: str, end: str,
                  days: int = BLOCK_DAYS, fan: int = FAN) -> DataFrame:
    """Pairs of ``points`` and the ``intervals`` of their key with start <= time <= end.

    A point is in one bucket a level and an interval on one level, so no pair appears twice. Points
    look at the levels that intervals lie on: one, unless some last over ``days`` * ``fan`` days.
    """
    clash = (set(points.columns) & set(intervals.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    cut = bucketed_intervals(intervals, start, end, days, fan)
    top = cut.agg(F.coalesce(F.max("_LEVEL"), F.lit(0)).alias("top")).scalar()
    spread = points.filter(F.col(time).isNotNull()).withColumn("_LEVEL", F.explode(F.sequence(F.lit(0), top)))
    spread = spread.withColumn("_BUCKET", F.floor(day_number(F.col(time)) / width_of(F.col("_LEVEL"), days, fan)))
    found = spread.join(cut, [*keys, "_LEVEL", "_BUCKET"]).filter((F.col(time) >= F.col(start)) & (F.col(time) <= F.col(end)))
    return found.drop("_LEVEL", "_BUCKET")


def costs_by_schedule(costs: DataFrame, schedule: DataFrame, days: int = BLOCK_DAYS) -> DataFrame:
    """Net costs (K, INVOICE_DATE, ACTUALS_COST) with the schedule row that covers their date.

    One row a cost: of several covering rows the first by (CURRENTSTART, CURRENTEND); ``COVERING_ROWS`` says how
    many there are, 0 and nulls without one. Where a key has two schedule rows the joined curve counts a cost twice;
    this one counts it once, at the row that it belongs to. Equal schedule rows are one.
    """
    s = select_schedule(schedule).dropna(subset=KEY)
    s = s.select(*KEY, to_timestamp_strict(s, "CURRENTSTART").alias("CURRENTSTART"),
                 to_timestamp_strict(s, "CURRENTEND").alias("CURRENTEND")).distinct()
    pairs = covering_join(costs.select(*KEY, "INVOICE_DATE"), s, KEY, "INVOICE_DATE", "CURRENTSTART", "CURRENTEND", days)
    first = pairs.groupBy(*KEY, "INVOICE_DATE").agg(
        F.min(F.struct("CURRENTSTART", "CURRENTEND")).alias("_FIRST"), F.count("*").alias("COVERING_ROWS"))
    return costs.join(first, [*KEY, "INVOICE_DATE"], "left").select(
        *costs.columns, F.col("_FIRST.CURRENTSTART").alias("CURRENTSTART"), F.col("_FIRST.CURRENTEND").alias("CURRENTEND"),
        F.coalesce("COVERING_ROWS", F.lit(0).cast("long")).alias("COVERING_ROWS"))


def schedule_row_totals(costs: DataFrame, schedule: DataFrame) -> DataFrame:
    """Per key and schedule row: days with costs and their sum; costs that no row covers stand under null dates."""
    rows = costs_by_schedule(costs, schedule)
    return rows.groupBy(*KEY, "CURRENTSTART", "CURRENTEND").agg(
        F.count("*").alias("COST_DAYS"), F.sum("ACTUALS_COST").cast(costs.schema["ACTUALS_COST"].dataType).alias("ACTUALS_COST"))


def costs_known_on(curves: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows (K, DATE, ...) with the running actual cost known on their date, and the day it dates from."""
    known = actual.select(*KEY, F.col("INVOICE_DATE").alias("ACTUAL_DATE"), F.col("CUMULATIVE_ACTUAL_COST").alias("ACTUAL_TO_DATE"))
    return as_of_join(curves, known, KEY, "DATE", "ACTUAL_DATE", ["ACTUAL_TO_DATE"])
