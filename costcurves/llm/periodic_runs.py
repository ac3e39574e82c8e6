"""Operator 12: periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at
least max(6, 4 * q) words that no neighbouring word extends. All runs of a text are found; a text's repeated
words then collapse to the first period of each run.

1. Spark deals the documents; a task works on slices of them, each document with word numbers of its own, so
   that nothing matches across documents.
2. Suffix array of the slice by prefix doubling. At the step that sorts by the first m = 2^k words, the dyadic
   blocks (m words from a multiple of m on) read their interval of the array.
3. A wavelet tree over the suffix array, visited level by level, answers for all blocks at once the range
   successor and predecessor: the next and the last occurrence of the block around it. Occurrences in the
   neighbouring window form a progression, whose difference d is a candidate period if m / 2 < d <= m.
4. Candidates of one progression are merged, extended to both sides and kept if they are long enough.

Nothing is missed: with m the smallest power of two not below q, a run of 4 * q words holds a whole block of m
words and its neighbour q words on or q words back. Nor does d exceed the smallest period: a smaller one would put an
occurrence between.

Defined cases: a null text reads as empty and has no runs. Null and repeated ids are rows like any other, one row
out for each row in. Memory grows with the longest text, in proportion; there is no limit on its length. An
empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import trimmed, whole_text
from .shingles import sliced

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_PERIODS = 6, 4
SLICE = 2 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Numbers(dict):
    """Words numbered in the order they are met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def numbered(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all documents in one array, equal only for equal words of one document; and the documents' bounds."""
    sizes = np.array([len(d) for d in docs], np.int64)
    numbers = Numbers()
    words = np.fromiter((n for d in docs for n in map(numbers.__getitem__, d)), np.int64, int(sizes.sum()))
    words += np.repeat(np.arange(len(docs), dtype=np.int64) * (len(numbers) + 1), sizes)
    return words, np.concatenate([[0], np.cumsum(sizes)])


def blocks_and_suffixes(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and rows (position, m, first, end): the interval of each dyadic block that occurs twice."""
    n = len(words)
    inside = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    order = np.argsort(words, kind="stable")
    new = np.r_[True, words[order[1:]] != words[order[:-1]]]
    rank = np.empty(n, np.int64)
    slots, blocks, m = np.arange(n), [], 1
    first = np.flatnonzero(new)
    group = np.repeat(first, np.diff(np.r_[first, n]))
    rank[order] = group
    size = np.repeat(np.diff(np.r_[first, n]), np.diff(np.r_[first, n]))
    while True:
        # ``slots``: places of the array whose suffixes are not told apart by m words yet.
        open_ = size > 1
        slots, group, size = slots[open_], group[open_], size[open_]
        if not len(slots):
            break
        at = order[slots]
        dyadic = (inside[at] % m == 0) & (left[at] >= m)
        blocks.append(np.stack([at[dyadic], np.full(int(dyadic.sum()), m), group[dyadic], group[dyadic] + size[dyadic]], 1))
        # Sorted by 2 m words: the rank of the suffix m words on tells members of a group apart.
        then = np.where(at + m < n, rank[np.minimum(at + m, n - 1)], -1)
        by = np.lexsort((then, group))
        at, then = at[by], then[by]
        order[slots] = at
        new = np.r_[True, (group[1:] != group[:-1]) | (then[1:] != then[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(slots)])
        group = np.repeat(slots[first], size)
        size = np.repeat(size, size)
        rank[at] = group
        m *= 2
    return order, np.concatenate(blocks) if blocks else np.empty((0, 4), np.int64)


def wavelet_levels(values: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
    """The wavelet tree's levels from the top: (bit, zeros before each place, all zeros). One level is held at a time."""
    for bit in range(int(values.max()).bit_length() - 1, -1, -1):
        ones = (values >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~ones)])
        yield bit, zeros, int(zeros[-1])
        values = np.concatenate([values[~ones], values[ones]])


def places_in(values: np.ndarray, first: np.ndarray, end: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many of values[first:end] are below x."""
    lo, hi, below = first, end, np.zeros(len(x), np.int64)
    for bit, zeros, total in wavelet_levels(values):
        zl, zh = zeros[lo], zeros[hi]
        one = x >> bit & 1 == 1
        below += np.where(one, zh - zl, 0)
        lo, hi = np.where(one, total + lo - zl, zl), np.where(one, total + hi - zh, zh)
    return below


def kth_of(values: np.ndarray, first: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The k-th smallest (from 0) of values[first:end]."""
    lo, hi, found = first, end, np.zeros(len(k), np.int64)
    for bit, zeros, total in wavelet_levels(values):
        zl, zh = zeros[lo], zeros[hi]
        one = k >= zh - zl
        k = k - np.where(one, zh - zl, 0)
        found |= one.astype(np.int64) << bit
        lo, hi = np.where(one, total + lo - zl, zl), np.where(one, total + hi - zh, zh)
    return found


def candidates(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of stretches with that period, one or more in each run."""
    order, blocks = blocks_and_suffixes(words, bounds)
    if not len(blocks):
        return (np.empty(0, np.int64),) * 3
    at, m, first, end = blocks.T
    place = places_in(order, first, end, at)
    starts, ends, periods = [], [], []
    for step in (1, -1):
        fits = (first + place + step < end) & (place + step >= 0)
        a, size = at[fits], m[fits]
        d = step * (kth_of(order, first[fits], end[fits], (place + step)[fits]) - a)
        near = (d <= size) & (2 * d > size)
        a, size, d = a[near], size[near], d[near]
        starts.append(a if step > 0 else a - d)
        ends.append(starts[-1] + d + size)
        periods.append(d)
    starts, ends, periods = map(np.concatenate, (starts, ends, periods))
    by = np.lexsort((starts, periods))
    starts, ends, periods = starts[by], ends[by], periods[by]
    # Stretches of one period that share a whole period are one; equal periods have equal blocks, so ends ascend.
    new = np.r_[True, (periods[1:] != periods[:-1]) | (starts[1:] > ends[:-1] - periods[:-1])] if len(by) else np.empty(0, bool)
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(by)] - 1
    return starts[heads], ends[tails], periods[heads]


def reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two arrays share from their start on."""
    at, step = 0, 16
    n = min(len(a), len(b))
    while at < n:
        other = np.flatnonzero(a[at:min(at + step, n)] != b[at:min(at + step, n)])
        if len(other):
            return at + int(other[0])
        at, step = at + step, 2 * step
    return n


def runs_of(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, ascending; starts count from the first document."""
    n = len(words)
    start, end, q = candidates(words, bounds)
    # A few words to both sides for all at once; most stop there and are too short.
    right, left = np.ones(len(q), bool), np.ones(len(q), bool)
    for _ in range(LEAST_WORDS):
        right &= (end < n) & (words[np.minimum(end, n - 1)] == words[np.minimum(end, n - 1) - q])
        end = end + right
        left &= (start > 0) & (words[np.maximum(start - 1, 0)] == words[np.maximum(start - 1, 0) + q])
        start = start - left
    need = np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    hopeful = right | left | (end - start >= need)
    found = set()
    for s, e, p, r, lf in zip(*(x[hopeful].tolist() for x in (start, end, q, right, left)), strict=True):
        if r:
            e += reach(words[e:], words[e - p:])
        if lf:
            s -= reach(words[:s][::-1], words[:s + p][::-1])
        if e - s >= max(LEAST_WORDS, LEAST_PERIODS * p):
            found.add((s, e - s, p))
    rows = sorted(found, key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def found_in(texts: list[bytes]) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of each text, and the text without the words that repeat an earlier period of their run."""
    docs = [t.split() for t in texts]  # bytes.split() cuts at ASCII white space only
    words, bounds = numbered(docs)
    rows = runs_of(words, bounds) if len(words) else np.empty((0, 3), np.int64)
    owner = np.searchsorted(bounds, rows[:, 0], side="right") - 1
    runs, kept = [[] for _ in docs], docs
    for i, (s, length, q) in zip(owner.tolist(), rows.tolist(), strict=True):
        runs[i].append({"start": s - int(bounds[i]), "length": length, "period": q})
    for i in np.unique(owner).tolist():
        stays = np.ones(len(docs[i]), bool)
        for r in runs[i]:
            stays[r["start"] + r["period"]:r["start"] + r["length"]] = False
        kept[i] = [w for w, s in zip(docs[i], stays.tolist(), strict=True) if s]
    return runs, [b" ".join(d) for d in kept]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SLICE) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start, then period, and its text without their repeats.

    A word goes if any run contains it after that run's first period; the others are joined by one space.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).cast("binary").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for part in sliced(rows, limit=size):
            runs, collapsed = found_in([t for _, t in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in part], pa.int64()), pa.array(runs, RUN_TYPE),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(trimmed(find), f"doc_id long, runs {RUNS}, collapsed string")


def strongest(runs: Column | str = "runs") -> Column:
    """The run of greatest length / period, compared as fractions; the first of equals; null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(more(a, b), b).otherwise(a))


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which a tenth of the texts, drawn by the id, repeat a stretch of their words to the end.

    With h the CRC-32 of the decimal id and g = h div 10, texts with h % 10 = 0 become periodic from word
    a = g % n on, with period 1 + (n - a) div (3 + g % 8). Null ids and texts without words stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    n, g, a, p = F.col("_n"), F.col("_g"), F.col("_a"), F.col("_p")
    out = docs.withColumn("_words", F.when(h % 10 == 0, F.regexp_extract_all(whole_text(text_col), F.lit(f"({WORD})"), F.lit(1))))
    out = out.withColumns({"_n": F.size("_words").cast("long"), "_g": F.floor(h / 10)})
    out = out.withColumn("_a", F.when(n > 0, g % n))
    out = out.withColumn("_p", F.when(n > 0, F.floor((n - a) / (3 + g % 8)) + 1))
    source = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
    moved = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("_words", source(i).cast("int"))), " ")
    return out.withColumn(text_col, F.when(n > 0, moved).otherwise(F.col(text_col))).select(*docs.columns)
