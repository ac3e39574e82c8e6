"""Operator 11: byte-level BPE by a global shuffle of distinct words.

Merges never cross the pre-tokens that the pattern cuts, so each distinct one is encoded once for the whole
corpus:

1. Explode. A slice of documents becomes its distinct pre-tokens, numbered, and the numbers of every document
   in order of position: equal pre-tokens of a slice are one row before any shuffle.
2. Pre-tokens are dealt and sorted by their bytes, so a task meets each distinct one once, encodes it by the
   ranks, and answers all slices that have it. A frequent word is at most one row a slice.
3. The ids join their slice back, and each document is put together by position.

Decoding looks the ids up in the token-byte table, which has one row a token of the vocabulary.

Slices are numbered by partition and place in it, and explode runs once for the words and once for the
documents, so rows must come in a repeatable order, as they do from files; write the result of a shuffle to a table first. A
slice that lacks an answer raises.

Defined cases: a null text reads as empty and has no ids. Null and repeated ids are rows like any other, one row
out for each row in. A very long text is a slice of its own and is encoded whole. An empty table gives an
empty result. Only the id and text columns are read. An id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import trimmed, whole_text
from .periodic_runs import Numbers
from .shingles import sliced
from .slice_bpe import stretches
from .word_cache import kept_by_worker

#: Bytes of text in a slice. The larger, the fewer rows of frequent pre-tokens; a task holds the numbers of one slice.
SLICE = 32 << 20
#: Pre-tokens of documents in one row of a slice, and answers sorted by slice at once.
BLOCK, ANSWERS = 1 << 16, 1 << 18
PARTS = "slice long, n int, doc_ids array<long>, counts binary, numbers binary, ids binary"
PART_TYPES = [("slice", pa.int64()), ("n", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("numbers", pa.binary()),
              ("ids", pa.binary())]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line a token, base64 bytes and the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def token_bytes(path: str) -> list[bytes | None]:
    """The token-byte table: the bytes of each id."""
    ranks = read_ranks(path)
    table = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def exploded(batches: Iterator[pa.RecordBatch], pattern: str, size: int) -> Iterator[tuple]:
    """(slice, doc ids, number sequences, words) of each slice of the partition."""
    compiled = kept_by_worker(("pre-tokens", pattern), lambda: regex.compile(pattern))
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for k, part in enumerate(sliced(rows, limit=size)):
        numbers = Numbers()
        sequences = [np.fromiter(map(numbers.__getitem__, compiled.findall(t)), np.uint32) for _, t, _ in part]
        yield part[0][2] << 32 | k, [i for i, _, _ in part], sequences, list(numbers)


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as one plane a byte, low bytes first, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel()


def parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(PART_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, PART_TYPES, strict=True)],
                                      names=[n for n, _ in PART_TYPES])


def answers(batches: Iterator[pa.RecordBatch], encode: Callable[[str], list[int]]) -> Iterator[pa.RecordBatch]:
    """The ids of each pre-token for every slice that has it; pre-tokens come sorted."""
    last, last_ids = None, None
    held, n = [], 0

    def by_slice() -> pa.RecordBatch:
        offset, slices, numbers, which, ids = 0, [], [], [], []
        for s, k, w, found in held:
            slices.append(s)
            numbers.append(k)
            which.append(w + offset)
            ids.extend(found)
            offset += len(found)
        slices, numbers, which = map(np.concatenate, (slices, numbers, which))
        counts = np.array([len(i) for i in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(ids), "<u4", int(counts.sum()))
        order = np.lexsort((numbers, slices))
        slices, numbers, which = slices[order], numbers[order], which[order]
        edges = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1], True]).tolist()
        return parts([(int(slices[a]), b - a, None, squeezed(counts[which[a:b]]), squeezed(np.diff(numbers[a:b], prepend=0)),
                       squeezed(stretches(counts, flat, which[a:b]))) for a, b in zip(edges[:-1], edges[1:], strict=True)])

    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column(0).dictionary_encode()
        words = coded.dictionary.to_pylist()
        found = [last_ids if w == last else encode(w.decode()) for w in words]
        which = coded.indices.to_numpy()
        last, last_ids = words[which[-1]], found[which[-1]]
        held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), which, found))
        n += batch.num_rows
        if n >= ANSWERS:
            yield by_slice()
            held, n = [], 0
    if held:
        yield by_slice()


def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of every document; answers come before the documents of their slice."""
    now, heard, counts, flat = None, [], None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["slice"] != now:
                now, heard, counts = r["slice"], [], None
            if r["doc_ids"] is None:
                n = unsqueezed(r["counts"], r["n"]).astype(np.int64)
                heard.append((np.cumsum(unsqueezed(r["numbers"], r["n"]).astype(np.int64)), n, unsqueezed(r["ids"], int(n.sum()))))
                continue
            if counts is None:
                numbers, n, ids = map(np.concatenate, zip(*heard, strict=True)) if heard else (np.empty(0, np.int64),) * 3
                order = np.argsort(numbers)
                if (numbers[order] != np.arange(len(numbers))).any():
                    raise RuntimeError("a slice's answers are not those of its words: rows came in another order")
                counts, flat = n[order], stretches(n, ids, order)
                heard = []
            lengths = np.frombuffer(r["counts"], "<i8")
            numbers = unsqueezed(r["numbers"], r["n"])
            if len(numbers) and int(numbers.max()) >= len(counts):
                raise RuntimeError("a slice lacks answers: rows came in another order")
            ids = stretches(counts, flat, numbers).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(counts[numbers])])[np.concatenate([[0], np.cumsum(lengths)])]
            yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])


def encoded(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            size: int = SLICE) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its text by the rank file ``ranks``, pre-tokens cut by ``pattern``."""
    # The number of the partition of rows: a task's own number would count the other branch of the union.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
                       F.spark_partition_id().alias("partition"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, _, found in exploded(batches, pattern, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.encode() for w in found], pa.binary()), pa.array(np.full(len(found), number)),
                 pa.array(np.arange(len(found), dtype=np.int32))], names=["word", "slice", "number"])

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, found, _ in exploded(batches, pattern, size):
            place = np.cumsum([len(s) for s in found]) // BLOCK
            for k in np.unique(place).tolist():
                a, b = np.searchsorted(place, [k, k + 1]).tolist()
                lengths = np.array([len(s) for s in found[a:b]], "<i8")
                yield parts([(number, int(lengths.sum()), ids[a:b], lengths.tobytes(), squeezed(np.concatenate(found[a:b])), None)])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The pattern of this encoding takes a pre-token whole.
        coder = kept_by_worker(("ranks", ranks), lambda: tiktoken.Encoding(
            "words", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(ranks), special_tokens={}))
        return answers(batches, coder.encode_ordinary)

    dealt = rows.mapInArrow(trimmed(words), "word binary, slice long, number int").repartition("word").sortWithinPartitions("word")
    joined = dealt.mapInArrow(trimmed(answer, ("ranks", ranks)), PARTS).unionByName(rows.mapInArrow(trimmed(sequences), PARTS))
    joined = joined.repartition("slice").sortWithinPartitions("slice", F.col("doc_ids").isNotNull())
    return joined.mapInArrow(trimmed(put_together), "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the column ``decoded``: the bytes that the ids stand for. Null ids give null."""
    names = rows.columns
    if "decoded" in names:
        raise ValueError("the rows have a column named decoded already")
    place = names.index(ids_col)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_by_worker(("token bytes", ranks), lambda: token_bytes(ranks))
        for batch in batches:
            found = [None if ids is None else b"".join(map(table.__getitem__, ids.tolist() if len(ids) else ()))
                     for ids in batch.column(place).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*names, "decoded"])

    return rows.mapInArrow(look_up, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
