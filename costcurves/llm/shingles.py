"""Sets of hashed word shingles, computed over many texts at a time with numpy.

Words are the runs of bytes other than ASCII white space, with A-Z lower-cased. A word's
64-bit hash is a polynomial over a table of byte values, a shingle's a linear
combination of five word hashes; both are mixed. A text of fewer words has one
shingle, its whole sequence; a text without words has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WIDTH = 5
#: Bytes hashed at once; longer inputs are cut at white space.
PIECE = 1 << 19
SLICE_BYTES = 1 << 21
SLICE_TEXTS = 50_000
NO_SET = np.empty(0, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence(n: int, start: int) -> np.ndarray:
    """n odd 64-bit numbers."""
    steps = np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps) | np.uint64(1)


BYTE = sequence(256, 1)
PLACE = sequence(WIDTH, 1000)
SHORT = sequence(WIDTH + 1, 2000)
BASE = sequence(1, 3000)[0]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def hashed_piece(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = SPACE[a]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    at = np.arange(len(a))
    inside = at - np.maximum.accumulate(np.where(first, at, 0))
    inside[space] = 0
    powers = np.full(int(inside.max()) + 1, BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    values = BYTE[a] * powers[inside]
    values[space] = 0
    length = np.add.reduceat((~space).astype(np.uint64), starts)
    return mix(np.add.reduceat(values, starts) + length * PLACE[0]), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word."""
    a, found, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(a):
        end = min(at + PIECE, len(a))
        if end < len(a):
            spaces = np.flatnonzero(SPACE[a[at:end]])
            while not len(spaces) and end < len(a):  # a word longer than a piece
                end = min(end + PIECE, len(a))
                spaces = np.flatnonzero(SPACE[a[at:end]])
            if len(spaces) and end < len(a):
                end = at + int(spaces[-1]) + 1
        h, s = hashed_piece(a[at:end])
        found.append((h, s + at))
        at = end
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([s for _, s in found])


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = b"\n".join(t or b"" for t in texts).lower()  # bytes.lower() changes A-Z only
    words, starts = word_hashes(data)
    edges = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    bounds = np.searchsorted(starts, edges)
    n = len(words) - WIDTH + 1
    every = mix(sum(words[i:n + i] * PLACE[i] for i in range(WIDTH))).view(np.int64) if n > 0 else NO_SET
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            s = np.sort(every[a:b - WIDTH + 1])
            sets.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:
            whole = words[a:b] * PLACE[:b - a]
            sets.append(mix(whole.sum(keepdims=True, dtype=np.uint64) + SHORT[b - a]).view(np.int64))
        else:
            sets.append(NO_SET)
    return sets


def sliced(rows: Iterable[tuple], size: int = 1, limit: int = SLICE_BYTES) -> Iterator[list[tuple]]:
    """Rows in lists of bounded total bytes; ``size`` is the place of the sized value in a row."""
    part, total = [], 0
    for row in rows:
        part.append(row)
        total += len(row[size] or b"")
        if total >= limit or len(part) >= SLICE_TEXTS:
            yield part
            part, total = [], 0
    if part:
        yield part
