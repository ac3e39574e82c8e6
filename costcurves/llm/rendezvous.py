"""Operator 5: sharding by weighted rendezvous hashing.

Every shard j draws -ln(u) / weight from a hash u of (record key, j); the
smallest draw wins. The draw of a shard does not depend on the others, so one
more shard only takes rows into itself.

Defined cases: a null key hashes as the empty string, so all null keys share a
shard. Equal keys share a shard. A null text has size 1 and the checksum of the
empty text. Rows that agree in key, size and checksum take neighbouring slots in
any order. A very long text only counts by its bytes and checksum. An empty table gives an empty result. Only the id
and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unit_hash, whole_text

SHARDS = 8
SEED = "shard"
#: Hash blocks in which a shard's rows are numbered. A block of a shard holds 1 / (shards x blocks) of all rows.
BLOCKS = 1024


def shard_of(key: Column, weights: list[float], seed: str = SEED) -> Column:
    """Number of the shard with the smallest draw; the lower number on a tie."""
    draws = [F.struct((-F.ln(unit_hash(F.lit(seed), F.lit(j), key)) / F.lit(float(w))).alias("draw"),
                      F.lit(j).alias("shard")) for j, w in enumerate(weights) if w > 0]
    return (draws[0] if len(draws) == 1 else F.least(*draws))["shard"].cast("int")


def numbered(rows: DataFrame, blocks: int, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each shard, without one task a shard.

    Slots run over hash blocks: the counts of (shard, block), at most shards x blocks
    rows, give each block its first slot, and rows are numbered inside their block.
    """
    rows = rows.withColumn("block", F.floor(unit_hash(F.lit("slot"), F.col("doc_id")) * blocks).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("shard", "block").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = rows.withColumn("place", F.row_number().over(inside))
    # At most shards x blocks rows by construction.
    return (rows.join(F.broadcast(first), ["shard", "block"])
            .withColumn("slot", (F.col("first_slot") + F.col("place") - 1).cast("long"))
            .drop("block", "first_slot", "place"))


def sharded(docs: DataFrame, weights: list[float], blocks: int, grown_weight: float = 1.0,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per record with its shard, slot and the shard it has with one more shard."""
    text = whole_text(text_col)
    key = F.col(id_col)
    rows = docs.select(
        key.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, grown_weight]).alias("grown_shard"))
    return numbered(rows, blocks, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
