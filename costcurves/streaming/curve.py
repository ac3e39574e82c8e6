"""A stateful stream of cost files that keeps the actual curve up to date.

Files that arrive in the source folders are read as they come, in any order. The state store holds the
net cost of every key and invoice date; a micro-batch emits the new total of each date it touched (update
mode), and the curve's table takes those totals and shifts the running totals after them
(``CostState.set_totals``). Totals are absolute, so a micro-batch that runs again after a failure changes
nothing.

A credit of any age corrects the curve: the state has no watermark, since dates that expire would lose theirs. It
is kept in RocksDB on disk, one row a key and date, and its size is that of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.coerce import to_timestamp_strict
from ..operators.actuals import cost_amounts, union_cost_sources
from ..plans.incremental import CostState
from ..schema import KEY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_costs(spark: SparkSession, folders: dict[str, T.StructType], state: CostState, checkpoint: str,
                 files_at_once: int = 100, once: bool = True) -> StreamingQuery:
    """Start the stream over source folders (with their schemas) into ``state``.

    ``checkpoint`` is a shared folder of its own; a query started again with it goes on where it ended.
    ``once``: read what is there and end, instead of waiting for more. At most ``files_at_once`` files of each
    folder make a micro-batch.
    """
    sources = [spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
               for folder, schema in folders.items()]
    costs = union_cost_sources(*sources)
    totals = costs.select(*KEY, to_timestamp_strict(costs, "INVOICE_DATE").alias("INVOICE_DATE"),
                          cost_amounts(costs).alias("ACTUALS_COST")).dropna(subset=[*KEY, "INVOICE_DATE"])
    totals = totals.groupBy(*KEY, "INVOICE_DATE").agg(F.sum("ACTUALS_COST").alias("ACTUALS_COST"))

    def update(rows: DataFrame, batch: int) -> None:
        state.set_totals(rows, f"stream-{batch}")

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(update)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
