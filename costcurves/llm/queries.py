"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cotraining,
    line_chunks,
    periodic_runs,
    pii_boost,
    pivot_join,
    poisson_mix,
    record_files,
    rendezvous,
    spelling,
    spm_tokenizers,
    spotsigs,
    stream_dedup,
    word_bpe,
)
from .common import documents, shared_folder
from .oracle_sql import oracle_sql

__all__ = ["oracle_sql", "queries"]

#: Blocks of row ranges for each shuffle partition, so that block sizes follow the cluster's setting.
BLOCKS_PER_PARTITION = 8


def _blocks(spark: SparkSession) -> int:
    return BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_neighbours(documents(spark, sf_dir), _blocks(spark))


def op2_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_chunks.without_repeats(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_lines", "n_chunks", "removed_chunks", "removed_lines",
        F.length("clean_text").cast("long").alias("clean_chars"),
        F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_chunks.without_passages(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_lines", "removed_lines", F.length("clean_text").cast("long").alias("clean_chars"),
        F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))


def op3_pivot_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_join.linked_documents(documents(spark, sf_dir))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = poisson_mix.mixed(documents(spark, sf_dir))
    return rows.select("doc_id", "text", "lang", "source", F.round("mix_rate", 6).alias("rate"),
                       F.col("mix_copies").cast("long").alias("copies"), F.col("mix_copy").cast("long").alias("copy"),
                       F.col("mix_order").alias("order_key"))


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.sharded(documents(spark, sf_dir), [1.0] * rendezvous.SHARDS, rendezvous.BLOCKS)


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "records")
    manifest = record_files.write_records(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), folder,
                                          blocks, added=True)
    return record_files.read_back(manifest, blocks).select("doc_id", "start", "n_tokens", "ids_crc32")


def spm_model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op8_spm_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spm_tokenizers.encoded(documents(spark, sf_dir), spm_model())
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        F.length("decoded").cast("long").alias("decoded_chars"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "parity")


def op9_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup.deduplicated(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii_boost.personal_data(documents(spark, sf_dir))
    count = {k: pii_boost.count_of("base", k).cast("long").alias(f"n_{k}") for k in pii_boost.KINDS}
    digest = F.sha2(pii_boost.written(F.col("base")).cast("binary"), 256)
    return rows.select("doc_id", *count.values(), digest.alias("base_sha256"),
                       pii_boost.written(F.col("spans")).alias("spans"),
                       pii_boost.count_of("spans", pii_boost.SECRET).cast("long").alias("n_secret"),
                       (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = word_bpe.decoded(word_bpe.encoded(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.periodic_runs(periodic_runs.with_planted_periods(documents(spark, sf_dir)))
    rows = rows.withColumn("best", periodic_runs.strongest())
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spelling.spelling_variants(documents(spark, sf_dir), drop_every=spelling.DROP_EVERY)
    return rows.select("word", "n", "n_near", "form", "form_n", "root")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_spotsigs, op2_line_chunks, op2_passages, op3_pivot_join, op4_poisson_mix, op5_rendezvous, op6_cotraining,
        op7_record_files, op8_spm_tokenizers, op9_stream_dedup, op10_pii_boost,
        op11_word_bpe, op12_periodic_runs, op13_spelling_variants)}

