"""A training-data pipeline over ``documents``, one operator a stage.

Each stage reads all that the one before it kept, and its decisions take effect: documents that
the classifier rejects go, of equal texts the row with the smallest id stays, of linked
documents the one with the smallest id, each remaining one appears as often as its Poisson count
says, and every copy is encoded.

Defined cases: null texts and metadata pass through as the operators define them. Ids that repeat or are
null do not join rows: each row is a document of its own, the smallest id stays, null counting as the
largest, and exactly one row of each group does. An empty table gives an empty result. Columns besides those of ``documents`` are left out.

A session that sets no bound on the bytes of an Arrow batch gets one (``common.with_small_batches``); it changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costcurves.llm import cotraining, pivot_join, poisson_mix, spm_tokenizers, stream_dedup
from costcurves.llm.common import documents, stored, with_small_batches, without
from costcurves.llm.queries import spm_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    with_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.accepted(docs.select(*COLUMNS), labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return stream_dedup.one_of_equal(docs.select(*COLUMNS))


def drop_linked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles the one with the smallest id."""
    with_small_batches(spark)
    docs = docs.select(*COLUMNS)
    if docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty():
        found = pivot_join.linked_documents(docs).filter("component_id != doc_id").select("doc_id")
        return without(docs, stored(found, "pipeline-linked"))
    # Ids repeat or are null: each row gets a number of its own, fixed once written.
    rows = stored(docs.withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*COLUMNS), F.col("row").alias("row")).alias("place")
    found = pivot_join.linked_documents(rows, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    found = stored(found.join(rows.select("row", place), "row"), "pipeline-linked")
    first = found.groupBy("component_id").agg(F.min("place").alias("first")).select(F.col("first.row").alias("row"))
    gone = stored(found.select("row").join(first, "row", "left_anti"), "pipeline-gone")
    return without(rows, gone, "row").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its Poisson count says, in one global pseudo-random order."""
    return poisson_mix.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every copy; ``round_trip``: the ids decode to the text."""
    with_small_batches(spark)
    rows = spm_tokenizers.encoded(docs, spm_model())
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip", "parity")


STAGES = [("quality_classifier", keep_quality), ("exact_dedup", drop_copies), ("jaccard_join", drop_linked),
          ("mixing", mix_sources), ("sentencepiece", encode)]
#: Stages with a fitted model and a tokenizer have no SQL; tests/llm/test_pipeline.py holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
