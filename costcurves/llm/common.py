"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import math
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` for the tables of one run.

    The cluster names that folder; only a local session that has none gets a
    temporary one. The folder is removed when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to a shared folder and read back: later jobs start from its files."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: The bound of a batch of rows on its way to a Python worker, and what a session gets that has set none.
BATCH_BYTES, FEW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def with_small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of a batch for ``mapInArrow``, unless the session has set a bound itself.

    Without one, a batch is ten thousand rows: of whole texts some 30 to 60 MB, which the executor holds while it
    writes them and a worker twice, the batch at hand and the next.
    """
    if not spark.conf.get(BATCH_BYTES, None):
        spark.conf.set(BATCH_BYTES, FEW_BYTES)


def trimmed(f: Callable, keeps: object = None) -> Callable:
    """A function of ``mapInArrow`` that leaves its worker small for the stages after it.

    What other operators have kept in the worker (``kept_by_worker``; all but the key ``keeps``) goes at its
    start, and freed memory goes back to the system at its end.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = getattr(sys.modules.get("_kept_by_worker"), "__dict__", {})
        for key in [k for k in kept if isinstance(k, tuple) and k != keeps]:
            del kept[key]
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library

    return run


def whole_text(column: str | Column = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def unit_hash(*parts: Column) -> Column:
    """A double in (0, 1) from the MD5 of the parts joined by ':' (null: empty)."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2**48))


def row_order(c: str = "doc_id") -> list[Column]:
    """Ascending ids, null last."""
    return [F.col(c).isNull().asc(), F.col(c).asc()]


def id_bounds(df: DataFrame, blocks: int, c: str = "doc_id") -> list[int]:
    """Ascending upper ends of at most ``blocks`` ranges of ``c`` with about equally many rows.

    At most ``blocks`` numbers reach the driver. They only place rows in blocks;
    any bounds give the same results.
    """
    if blocks < 2:
        return []
    cuts = [(i + 1) / blocks for i in range(blocks - 1)]
    found = df.agg(F.percentile_approx(c, cuts, max(10_000, 20 * blocks)).alias("b")).first()["b"]
    return sorted(set(found or []))


def block_of(c: Column, bounds: list[int]) -> Column:
    """Number of the range that holds ``c`` (null: after the last).

    The bounds are one literal of the plan; a row looks at about twice the square root of their number.
    """
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds))
    below = lambda edges: F.size(F.filter(edges, lambda b: b < c))
    whole = below(F.lit(np.array(bounds[step - 1::step], np.int64))) * step
    place = whole + below(F.slice(F.lit(np.array(bounds, np.int64)), whole + 1, F.lit(step)))
    return F.when(c.isNull(), F.lit(len(bounds))).otherwise(place).cast("int")


#: Bits of the fixed-size filter of ``maybe_in``: one megabyte whatever the number of keys.
FILTER_BITS = 1 << 23


def maybe_in(rows: DataFrame, keys: DataFrame, c: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose ``c`` may be among ``keys``, and those whose ``c`` certainly is not.

    A bit a key's hash, built by partial aggregation, is broadcast: at most FILTER_BITS / 32768 bitmaps of 4 KB.
    An exact join of the first part then moves few rows; the texts of the others are not shuffled.
    """
    place = F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    marks = keys.filter(F.col(c).isNotNull()).select(
        F.bitmap_bucket_number(place).alias("filter_bucket"), F.bitmap_bit_position(place).alias("bit"))
    marks = marks.groupBy("filter_bucket").agg(F.bitmap_construct_agg("bit").alias("filter_bits"))
    found = rows.withColumn("filter_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(marks), "filter_bucket", "left")
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("filter_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.col(c).isNotNull() & (F.getbit(byte, (bit % 8).cast("int")) == 1), F.lit(False))
    return found.filter(hit).select(*rows.columns), found.filter(~hit).select(*rows.columns)


def without(rows: DataFrame, keys: DataFrame, c: str = "doc_id") -> DataFrame:
    """The rows whose ``c`` is not among ``keys``; null stays."""
    doubtful, sure = maybe_in(rows, keys, c)
    return sure.unionByName(doubtful.join(keys.select(c).distinct(), c, "left_anti").select(*rows.columns))
