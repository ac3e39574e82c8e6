"""The actual curve kept up to date by batches of late costs.

The state is one table of net costs, one row a key and invoice date: (K, INVOICE_DATE, ACTUALS_COST,
RUNNING_COST), in folders by a hash of the key. A batch is summed per key and date and merged:

* only folders that hold a key of the batch are read and written; files of the others keep their names;
* dates of the batch get its costs added, and the running totals of the touched folders are summed again, in blocks of
  days: their rows are shuffled once, which a shift of the old totals would need as well. What a key has before a block
  comes with the rows, as one more row of the block, and rows are dealt by (folder, block), so they are written where they lie.

Dates whose costs cancel out stay in the state with 0, since a later batch may change them; the curve leaves
them out. A merge first writes its folders apart and then moves them, one by one, to the place of the touched ones: until then a
failure leaves the old state, and lost executors never read a folder that is being replaced. The numbers of the touched
folders, at most ``PARTS``, are all that the driver sees.

Merged batches leave their name beside the table, so a batch that is delivered again changes nothing. Should the driver end
while folders are moved, the next call with the batch's name moves the others: rows of touched folders are whole, and one
that was moved is no longer apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.actuals import budget_rollup, curve_rows, daily_costs, union_cost_sources
from ..operators.temporal import ROW_DAYS, block_of
from ..schema import ACTUAL_COLUMNS, FREE_SCALE, KEY, MONEY_DIGITS

PARTS = 64
AMOUNT_TYPE = f"decimal({MONEY_DIGITS},{FREE_SCALE})"
STATE = ("PROJECT_NUMBER string, STAGE string, SUB_STAGE string, INVOICE_DATE timestamp_ntz, "
         f"ACTUALS_COST {AMOUNT_TYPE}, RUNNING_COST {AMOUNT_TYPE}, PART int")


class CostState:
    """The state under ``folder``, which all executors share.

    ``parts``: folders of the table; it is fixed by the first batch.
    """

    def __init__(self, spark: SparkSession, folder: str, parts: int = PARTS):
        self.spark, self.folder, self.parts = spark, folder.rstrip("/"), parts
        self.table, self.staged, self.done = (f"{self.folder}/{d}" for d in ("state", "staged", "batches"))

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        files, path = self._path(name)
        return files.exists(path)

    def rows(self) -> DataFrame:
        """The state's rows; none before the first batch."""
        if not self._exists(self.table):
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(self.table)

    def merge(self, sources: list[DataFrame], batch: str) -> None:
        """Add a batch of cost rows. ``batch`` names it; a name that was merged before is left out."""
        self._write(self._placed(daily_costs(union_cost_sources(*sources), zeros=True)), batch)

    def set_totals(self, totals: DataFrame, batch: str) -> None:
        """Make these (K, INVOICE_DATE, ACTUALS_COST) the costs of their dates, whatever the state has for them."""
        old = self.rows().select(*KEY, "INVOICE_DATE", F.col("ACTUALS_COST").alias("_OLD"))
        # By key and date, as a stream's totals are dealt already.
        new = self._placed(totals.dropna(subset=[*KEY, "INVOICE_DATE"])).join(old, [*KEY, "INVOICE_DATE"], "left")
        change = (F.col("ACTUALS_COST") - F.coalesce("_OLD", F.lit(0))).cast(AMOUNT_TYPE)
        self._write(new.withColumn("ACTUALS_COST", change).drop("_OLD").filter("ACTUALS_COST != 0"), batch)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*KEY, "INVOICE_DATE", F.col("ACTUALS_COST").cast(AMOUNT_TYPE).alias("ACTUALS_COST"),
                           F.pmod(F.hash(*KEY), F.lit(self.parts)).alias("PART"))

    def _write(self, changes: DataFrame, batch: str) -> None:
        if self._exists(f"{self.done}/{batch}"):
            return
        staged = f"{self.staged}/{batch}"
        if not self._exists(f"{staged}/_SUCCESS"):
            # Written first: a micro-batch is computed once.
            changes.write.mode("overwrite").parquet(f"{staged}-changes")
            changes = self.spark.read.schema(changes.schema).parquet(f"{staged}-changes")
            touched = sorted(r["PART"] for r in changes.select("PART").distinct().collect())
            merged(self.rows().filter(F.col("PART").isin(touched)), changes).write.partitionBy("PART").option(
                "partitionOverwriteMode", "static").mode("overwrite").parquet(staged)
        self._replace(staged)
        files, path = self._path(f"{self.done}/{batch}")
        files.create(path).close()
        for name in (staged, f"{staged}-changes"):
            files, path = self._path(name)
            files.delete(path, True)

    def _replace(self, staged: str) -> None:
        """Put whole folders in the place of old ones."""
        files, path = self._path(staged)
        _, table = self._path(self.table)
        files.mkdirs(table)
        for found in files.listStatus(path):
            if found.getPath().getName().startswith("PART="):
                _, target = self._path(f"{self.table}/{found.getPath().getName()}")
                files.delete(target, True)
                if not files.rename(found.getPath(), target):
                    raise OSError(f"{found.getPath()} was not moved to {target}")

    def curve(self, budget: DataFrame, schedule: DataFrame) -> DataFrame:
        """The actual curve of all batches so far, as ``actual_value`` gives it for their rows together."""
        rows = self.rows().filter(F.col("ACTUALS_COST") != 0).select(
            *KEY, "INVOICE_DATE", "ACTUALS_COST", F.col("RUNNING_COST").alias("CUMULATIVE_ACTUAL_COST"))
        return curve_rows(rows, budget_rollup(budget), schedule).select(*ACTUAL_COLUMNS)


def merged(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state's rows with a batch of changes (K, INVOICE_DATE, ACTUALS_COST, PART), one a key and date."""
    old = state.select(*KEY, "PART", "INVOICE_DATE", "ACTUALS_COST")
    rows = old.unionByName(changes.select(*old.columns)).dropna(subset=[*KEY, "INVOICE_DATE"])
    # Both sides have one row a key and date, so nothing is summed before this one shuffle.
    rows = rows.withColumn("_BLOCK", block_of(F.col("INVOICE_DATE"), ROW_DAYS)).repartition("PART", "_BLOCK")
    # The last date is read, so that sums and rows read the same columns and share the shuffle.
    sums = rows.groupBy("PART", "_BLOCK", *KEY).agg(F.sum("ACTUALS_COST").alias("_SUM"), F.max("INVOICE_DATE").alias("_LAST"))
    earlier = Window.partitionBy(*KEY, "PART").orderBy("_LAST").rowsBetween(Window.unboundedPreceding, -1)
    # A row without a date, the first of its block; a key's first block needs none.
    before = sums.withColumn("ACTUALS_COST", F.sum("_SUM").over(earlier).cast(AMOUNT_TYPE)).filter("ACTUALS_COST is not null")
    before = before.withColumn("INVOICE_DATE", F.lit(None).cast("timestamp_ntz")).select(*rows.columns)
    # Dealt as the rows are, so the union of both is.
    rows = rows.unionByName(before.repartition(int(state.sparkSession.conf.get("spark.sql.shuffle.partitions")), "PART", "_BLOCK"))
    by_date = Window.partitionBy("PART", "_BLOCK", *KEY).orderBy(F.col("INVOICE_DATE").asc_nulls_first())
    to_row, date = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow), by_date.rangeBetween(Window.currentRow, Window.currentRow)
    # One sort and one window, without an aggregate before: the last row of a date has what the date's rows add up to.
    rows = rows.select(*KEY, "PART", "INVOICE_DATE", F.lead("INVOICE_DATE").over(by_date).alias("_NEXT"),
                       F.sum("ACTUALS_COST").over(date).cast(AMOUNT_TYPE).alias("ACTUALS_COST"),
                       F.sum("ACTUALS_COST").over(to_row).cast(AMOUNT_TYPE).alias("RUNNING_COST"))
    rows = rows.filter("INVOICE_DATE is not null and (_NEXT is null or _NEXT <> INVOICE_DATE)")
    return rows.select(*KEY, "INVOICE_DATE", "ACTUALS_COST", "RUNNING_COST", "PART")
