"""Operator 1: SpotSigs document fingerprints.

A signature is a common word (the anchor) with the chain of the next content
words after it; the anchors between are passed over. A text's fingerprint is
the set of its signatures, and its string form the SHA-256 of the sorted set.
Two fingerprints are compared by Jaccard; sets whose length partitions lie too
far apart to reach the wanted likeness are settled without intersecting them.

Defined cases: a null text reads as empty. A text with words but no full chain, as in a language without
anchors, has its shingles of ``SHINGLE`` words (fewer words: all of them) as signatures. A text without words has the
empty set; two empty sets are alike (1.0), an empty and a filled one are not (0.0).
Rows with equal ids are ordered by a hash of their text, null ids come last. A very long text is read whole. An empty
table gives an empty result. Only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import block_of, id_bounds, whole_text

#: Common words used as anchors (English, French, German, Spanish).
ANCHORS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the",
    "this", "to", "was", "with",
    "dans", "de", "des", "du", "en", "et", "la", "le", "les", "pour", "que", "sur", "un", "une",
    "das", "den", "der", "die", "ein", "ist", "mit", "und", "von", "zu",
    "con", "del", "el", "las", "los", "no", "por", "se", "su", "y",
]
CHAIN = 3
DISTANCE = 1
SHINGLE = 5
WORD_BREAK = r"[^\p{L}\p{N}]+"
THRESHOLD = 0.75


def with_signatures(df: DataFrame, text: str, out: str, anchors: list[str] = ANCHORS,
                    chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """``df`` with ``out``: the sorted distinct signatures of column ``text``.

    The k-th anchor at word p has p - k content words before it, so its chain
    starts there in the list of content words: one pass, no nested search.
    """
    words, content, places = f"{out}__words", f"{out}__content", f"{out}__places"
    df = df.withColumn(words, F.filter(F.split(F.lower(whole_text(text)), WORD_BREAK), lambda w: w != ""))
    df = df.withColumn(content, F.filter(words, lambda w: ~w.isin(anchors)))
    df = df.withColumn(places, F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull()))

    def signature(p: Column, k: Column) -> Column:
        first = p - k
        chained = [F.get(F.col(content), first + j * distance) for j in range(chain)]
        whole = first + (chain - 1) * distance < F.size(content)
        return F.when(whole, F.concat_ws(" ", F.get(F.col(words), p), *chained))

    found = F.filter(F.transform(places, signature), lambda s: s.isNotNull())
    df = df.withColumn(out, F.sort_array(F.array_distinct(found)))
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE)), " "))
    alone = F.when(F.size(words) > 0, F.sort_array(F.array_distinct(shingles))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(alone)).drop(words, content, places)


def fingerprint(signatures: Column) -> Column:
    return F.sha2(F.array_join(signatures, "\n").cast("binary"), 256)


def length_partition(signatures: Column, threshold: float = THRESHOLD) -> Column:
    """Partition by set length: sets at least ``threshold`` alike lie in the same or neighbouring ones."""
    n = F.size(signatures)
    return F.when(n == 0, F.lit(-1)).otherwise(F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets, 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(shared / (total - shared))


def is_near(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    """Whether two sets are at least ``threshold`` alike, pruned by partition and length first."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = F.abs(length_partition(a, threshold) - length_partition(b, threshold)) > 1
    return F.when(apart | (low < high * threshold), False).otherwise(likeness(a, b) >= threshold)


def with_next(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, tie, block, guest) such that each row's successor in descending id order
    (after the last: the first) is the next row of its block.

    Ids fall in ``blocks`` ranges of about equally many rows. The first row of each block is
    also sent to the block before it as a guest, so the texts are shuffled once and
    no task orders more than a block.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    block = block_of(F.col("doc_id"), id_bounds(rows, blocks))
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(block))
    heads = rows.groupBy("block").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    every = Window.orderBy("block")
    heads = heads.select("block", "head", F.coalesce(
        F.lead("block").over(every), F.first("block").over(every)).alias("before"))
    # At most ``blocks`` + 2 rows by construction.
    rows = rows.join(F.broadcast(heads), "block", "left")
    is_head = F.struct("doc_id", "tie").eqNullSafe(F.col("head"))
    places = F.array_compact(F.array(
        F.struct(F.col("block").alias("at"), F.lit(False).alias("guest")),
        F.when(is_head, F.struct(F.col("before").alias("at"), F.lit(True).alias("guest")))))
    return rows.select("doc_id", "text", "tie", F.inline(places)).withColumnRenamed("at", "block")


def in_order() -> Window:
    return Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())


def edited_text(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by as many first ones of the next text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def compare_neighbours(docs: DataFrame, blocks: int) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next text."""
    order = in_order()
    rows = with_next(docs, blocks)
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.coalesce(F.lead("text").over(order), F.lit(""))))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = with_signatures(rows, "text", "signatures").drop("text")
    rows = with_signatures(rows, "edited", "edited_signatures")
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    rows = rows.withColumn("next_signatures", F.lead("signatures").over(order)).filter(~F.col("guest"))
    own, edited, following = (F.col(c) for c in ("signatures", "edited_signatures", "next_signatures"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(own).alias("fingerprint"),
        fingerprint(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"),
        F.size(own).cast("long").alias("n_signatures"),
        length_partition(own).cast("long").alias("length_partition"),
        is_near(own, edited).alias("same_as_edited"), is_near(own, following).alias("same_as_next"))
