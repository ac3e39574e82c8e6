"""Operator 9: exact dedup as a stateful stream.

Documents land as Parquet files with their normalised text and its SHA-256. A
Structured Streaming query reads what has landed since its last run and keeps, for
each digest, the smallest document id, a locator of that content (its landing file)
and the number of rows, in a RocksDB state store without expiry. The stream is
restartable: its state and progress live in the shared folder, and a later run reads new
files only. Digests with more than one row are hits; their full bytes are compared
before rows count as equal.

Defined cases: a null text reads as empty. Null ids come last. Rows with equal text
and equal id count separately in ``group_size``; one answer holds for all of them and
``kept`` is true for those with the id that stays. An empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import maybe_in, shared_folder, stored, whole_text

LANDED = "doc_id long, digest string, content string"
FILES_PER_BATCH = 32
#: Landed and doubtful rows hold whole texts; they are packed tighter than by the default.
PACKED = "zstd"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # An eighth of this is taken by each partition at once; an executor may hold dozens.
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # Else each partition of the state reserves disk for its logs ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


#: Tasks that a hot digest's rows are dealt to, and the rows for which another task is worth a copy of the content.
SALTS, ROWS_A_SALT = 16, 64


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; runs that are one space already are passed over."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++", " ")


def land(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Append documents to the landing folder."""
    content = normalised(whole_text(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), content.alias("content"))
    rows.select("doc_id", F.sha2(F.col("content").cast("binary"), 256).alias("digest"), "content").write.mode(
        "append").parquet(folder, compression=PACKED)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def advance(spark: SparkSession, landing: str, state: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Run the stream over the files that landed since its last run."""
    rows = (spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
            .select("digest", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id",
                                       F.col("_metadata.file_path").alias("locator")).alias("place")))
    keyed = rows.groupBy("digest").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    with settings(spark, STATE_CONF):
        query = (keyed.writeStream.outputMode("update").format("noop").option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def keyed_state(spark: SparkSession, state: str) -> DataFrame:
    """(digest, keep_id, locator, n): what the stream holds."""
    with settings(spark, STATE_CONF):
        held = spark.read.format("statestore").load(state)
        first, n = held.schema["value"].dataType.fieldNames()
        place = F.col(f"value.`{first}`")
        return held.select("key.digest", place["doc_id"].alias("keep_id"), place["locator"].alias("locator"),
                           F.col(f"value.`{n}`").alias("n"))


def verified(landed: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every landed row (doc_id, digest, content, file).

    Rows whose digest the stream met once are settled. For each hit the state names the document that stays and where
    it lies; its content is read there and compared with the hit's, byte for byte. Rows of a digest that stands for
    different contents, if there is any, are grouped by content.
    """
    hits = held.filter("n > 1")
    doubtful, sure = maybe_in(landed, hits, "digest")

    def alone(rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), "digest")

    # A digest of a third of all rows is spread over SALTS tasks; the state's rows are small.
    salt = lambda parts: F.pmod(F.xxhash64("doc_id", "file"), parts).cast("int")
    spread = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = doubtful.withColumn("salt", salt(F.lit(SALTS))).join(spread, ["digest", "salt"], "left").drop("salt")
    rows = stored(rows, "dedup-hits", PACKED)
    met = rows.filter("n is not null")
    # The first contents go to as many tasks as their rows are dealt to.
    parts = F.least(F.lit(SALTS), F.ceil(F.col("n") / ROWS_A_SALT)).cast("int")
    firsts = met.filter((F.col("file") == F.col("locator")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(
        F.min("content").alias("first"), F.max("n").alias("n"))
    firsts = firsts.select("digest", "first", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    same = F.coalesce(F.col("content") == F.col("first"), F.lit(False))
    compared = met.withColumn("salt", salt(parts)).join(firsts, ["digest", "salt"], "left").select(
        "doc_id", "digest", "keep_id", "n", same.alias("same"))
    compared = stored(compared, "dedup-compared")
    odd = compared.filter("not same").select("digest").distinct()
    settled = compared.join(odd, "digest", "left_anti").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
    apart = met.join(odd, "digest", "left_semi")
    groups = apart.groupBy("digest", "content").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"))).alias("least"), F.count("*").alias("group_size"))
    apart = apart.select("doc_id", "digest", "content").join(groups, ["digest", "content"]).select(
        "doc_id", F.col("least.id").alias("keep_id"), "group_size",
        F.col("doc_id").eqNullSafe(F.col("least.id")).alias("kept"), "digest")
    return alone(sure).unionByName(alone(rows.filter("n is null"))).unionByName(settled).unionByName(apart)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Land the documents in a new folder, run the stream over them and verify its hits."""
    spark = docs.sparkSession
    landing, state = shared_folder(spark, "dedup-landing"), shared_folder(spark, "dedup-state")
    land(docs, landing, id_col, text_col)
    advance(spark, landing, state)
    held = stored(keyed_state(spark, state), "dedup-held")
    landed = spark.read.schema(LANDED).parquet(landing)
    return verified(landed.select("*", F.col("_metadata.file_path").alias("file")), held)


def one_of_equal(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, others) with one row of each normalised text: the smallest id, null last."""
    spark, columns = docs.sparkSession, docs.columns
    landing, state = shared_folder(spark, "dedup-landing"), shared_folder(spark, "dedup-state")
    land(docs, landing)
    advance(spark, landing, state)
    hits = stored(keyed_state(spark, state).filter("n > 1").select("digest"), "dedup-held")
    rows = docs.withColumn("digest", F.sha2(normalised(whole_text()).cast("binary"), 256))
    # A row that the filter lets through without a hit is alone with its text and stays as such.
    doubtful, sure = maybe_in(rows, hits, "digest")
    # Ids repeat, so each row gets a number of its own, fixed once written.
    doubtful = stored(doubtful.withColumn("row", F.monotonically_increasing_id()), "dedup-doubtful", PACKED)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*columns), F.col("row").alias("row"))
    first = doubtful.groupBy("digest", normalised(whole_text()).alias("content")).agg(F.min(place).alias("first"))
    left = doubtful.join(first.select(F.col("first.row").alias("row")), "row", "left_semi")
    return sure.select(*columns).unionByName(left.select(*columns))
