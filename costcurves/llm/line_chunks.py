"""Operator 2: line dedup over content-defined chunks of lines.

Lines are hashed; a rolling hash over the hashes of the last ``WINDOW`` lines
ends a chunk where it meets a fixed pattern. The cuts depend on nearby lines
only, so an inserted line moves the cuts around it and no others, and a passage
of several lines that repeats elsewhere is cut alike there. A chunk of at least
two lines that occurs earlier (smaller doc_id, then position) is removed after
its bytes are compared with that first occurrence.

Defined cases: a null text reads as empty and has no lines to remove. Chunks of
one line, or without a character besides white space, stay. Null ids come last;
rows that agree in id and text count as one and get the same answer. A very long text is cut like any other. An
empty table gives an empty result. Only the id and text columns are read.

Chunks miss the ends of a passage, and often all of a short one. ``without_passages`` takes each two
neighbouring lines instead: a line goes if it stands in two lines that occur earlier without overlap, so a
repeated passage of two lines or more goes whole. A line that repeats alone stays. A line is removed only for
an equal one in an earlier place, so each line removed remains somewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_in, stored, whole_text

WINDOW = 2
#: A cut comes after about one in this many lines.
SPACING = 4
BASE = 31


def line_number(line: Column) -> Column:
    """28 bits of the line's MD5 as a number."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def with_chunks(df: DataFrame, window: int = WINDOW, spacing: int = SPACING) -> DataFrame:
    """``df`` (doc_id, text) with ``lines`` and ``chunks``: (first, n) of each chunk, lines counted from 0."""
    df = df.withColumn("lines", F.split("text", "\n"))
    df = df.withColumn("numbers", F.transform("lines", line_number))

    def rolled(x: Column, i: Column) -> Column:
        total = x
        for back in range(1, window):
            total = total + F.coalesce(F.get(F.col("numbers"), i - back), F.lit(0)) * BASE**back
        return total

    df = df.withColumn("last", F.size("lines") - 1)
    df = df.withColumn("ends", F.filter(
        F.transform("numbers", lambda x, i: F.when((rolled(x, i) % spacing == 0) | (i == F.col("last")), i)),
        lambda i: i.isNotNull()))
    first = lambda k: F.coalesce(F.get(F.col("ends"), k - 1) + 1, F.lit(0))
    return df.withColumn("chunks", F.transform("ends", lambda e, k: F.struct(
        first(k).alias("first"), (e - first(k) + 1).alias("n")))).drop("numbers", "last", "ends")


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["first"] + 1, chunk["n"]), "\n")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first, n): the chunks to remove."""
    several = F.filter("chunks", lambda c: c["n"] >= 2)
    texts = F.transform(several, lambda c: F.struct(c["first"], c["n"], chunk_text(F.col("lines"), c).alias("bytes")))
    # Only the chunks go through explode: with the lines beside them a long text would be copied for each chunk.
    flat = with_chunks(docs).select("doc_id", "text_hash", F.explode(texts).alias("chunk"))
    flat = flat.filter(F.col("chunk.bytes").rlike(r"[^\x20\x09-\x0D]"))
    # Marks alone first; the bytes follow only for those that occur twice, which the filter lets through.
    flat = flat.withColumn("mark", F.xxhash64("chunk.bytes"))
    twice = stored(flat.groupBy("mark").count().filter("count > 1").select("mark"), "chunk-marks")
    flat = maybe_in(flat, twice, "mark")[0]
    flat = flat.select(F.sha2(F.col("chunk.bytes").cast("binary"), 256).alias("key"), F.col("chunk.bytes").alias("bytes"),
                       F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash",
                                F.col("chunk.first").alias("first"), F.col("chunk.n").alias("n")).alias("at"))
    # First occurrences: combined before the shuffle, so a chunk in a third of all documents is one row a task.
    firsts = flat.groupBy("key").agg(F.count("*").alias("times"), F.min(F.struct("at", "bytes")).alias("first"))
    firsts = firsts.filter("times > 1").select("key", "first")
    later = flat.join(firsts, "key").filter((F.col("bytes") == F.col("first.bytes")) & (F.col("at") > F.col("first.at")))
    return later.select("at.doc_id", "at.text_hash", "at.first", "at.n")


def with_starts(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` with ``starts``: the first lines of what goes from their text; null if nothing does.

    Only texts of which something may go are shuffled.
    """
    by_doc = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("first").alias("starts"))
    by_doc = by_doc.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "starts")
    doubtful, sure = maybe_in(rows, gone, "text_hash")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    doubtful = doubtful.join(by_doc, same, "left").select(*rows.columns, "starts")
    return doubtful.unionByName(sure.withColumn("starts", F.lit(None).cast("array<int>")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_chunks, removed_chunks, removed_lines, clean_text) of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = with_chunks(with_starts(rows, stored(repeated_chunks(rows), "line-chunks")))
    starts = F.coalesce("starts", F.array().cast("array<int>"))
    rows = rows.withColumn("kept", F.filter("chunks", lambda c: ~F.array_contains(starts, c["first"])))
    kept_lines = F.aggregate("kept", F.lit(0), lambda a, c: a + c["n"])
    clean = F.array_join(F.transform("kept", lambda c: chunk_text(F.col("lines"), c)), "\n")
    return rows.select(
        "doc_id", "text", F.size("lines").cast("long").alias("n_lines"), F.size("chunks").cast("long").alias("n_chunks"),
        (F.size("chunks") - F.size("kept")).cast("long").alias("removed_chunks"),
        (F.size("lines") - kept_lines).cast("long").alias("removed_lines"), clean.alias("clean_text"))


def with_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first, bytes, mark): each two neighbouring lines that hold more than white space."""
    lines = F.split("text", "\n")
    docs = docs.select("doc_id", "text_hash", lines.alias("lines"))
    pairs = F.transform(F.slice("lines", F.lit(2), F.size("lines")), lambda x, i: F.struct(
        i.alias("first"), F.concat(F.get("lines", i), F.lit("\n"), x).alias("bytes")))
    flat = docs.select("doc_id", "text_hash", F.explode(pairs).alias("pair"))
    flat = flat.filter(F.col("pair.bytes").rlike(r"[^\x20\x09-\x0D]"))
    return flat.select("doc_id", "text_hash", "pair.first", "pair.bytes", F.xxhash64("pair.bytes").alias("mark"))


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first): two lines from ``first`` on that occur earlier without overlap."""
    flat = with_pairs(docs)
    # Marks alone first; the bytes follow only for those that occur twice, which the filter lets through.
    twice = stored(flat.groupBy("mark").count().filter("count > 1").select("mark"), "line-marks")
    flat = maybe_in(flat, twice, "mark")[0]
    flat = flat.select(F.sha2(F.col("bytes").cast("binary"), 256).alias("key"), "bytes", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "first").alias("at"))
    firsts = flat.groupBy("key").agg(F.count("*").alias("times"), F.min(F.struct("at", "bytes")).alias("first"))
    firsts = firsts.filter("times > 1").select("key", "first")
    later = flat.join(firsts, "key").filter((F.col("bytes") == F.col("first.bytes")) & (F.col("at") > F.col("first.at")))
    same_row = F.col("at.doc_id").eqNullSafe(F.col("first.at.doc_id")) & (F.col("at.text_hash") == F.col("first.at.text_hash"))
    later = later.filter(~same_row | (F.col("at.first") >= F.col("first.at.first") + 2))
    return later.select("at.doc_id", "at.text_hash", F.col("at.first").alias("first"))


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, removed_lines, clean_text) of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = with_starts(rows, stored(repeated_pairs(rows), "line-pairs")).withColumn("lines", F.split("text", "\n"))
    starts = F.coalesce("starts", F.array().cast("array<int>"))
    removed = F.array_union(starts, F.transform(starts, lambda i: i + 1))
    rows = rows.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), removed))
    clean = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    return rows.select("doc_id", "text", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size("kept")).cast("long").alias("removed_lines"), clean.alias("clean_text"))
