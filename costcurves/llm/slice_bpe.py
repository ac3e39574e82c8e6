"""Byte-level BPE of a slice of texts by the tokenizers library, each distinct piece of the slice once.

Byte-level BPE works inside pre-tokens that begin at a single space between characters that are no white space, so
texts are cut there. Cutting, finding the distinct pieces and putting the ids together are array operations; the library
sees distinct pieces only, and those that a worker keeps from the slices before only once. Texts whose cuts are not
certain, or that spell out an added token, are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .shingles import sliced
from .word_cache import AT_ONCE, JOINED

SLICE = 8 << 20
#: Pieces that a worker keeps from slice to slice, those met first, and the most bytes of one: some 20 MB with their ids, 80 at most.
KEPT_PIECES, KEPT_BYTES = 500_000, 32


def text_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut in slices of at most ``limit`` bytes of a text column; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, before = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])


def stretches(counts: np.ndarray, flat: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The stretches ``picks`` of ``flat``, one after another; ``counts`` are the lengths of all stretches."""
    starts = np.cumsum(counts) - counts
    taken = counts[picks]
    before = np.cumsum(taken) - taken
    return flat[np.repeat(starts[picks] - before, taken) + np.arange(int(taken.sum()))]


class SliceBpe:
    """``added``: the file's added tokens get their ids where a text spells them out, as the library does by default;
    otherwise special ones are encoded as any other text."""

    def __init__(self, path: str, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        #: Bytes that each id stands for: a byte-level token has one character a byte.
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        #: Pieces kept, and as ``whole`` their ids with a space before each.
        self.kept, self.kept_counts, self.kept_ids = pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int32)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids)."""
        counts, ids = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        # The library's results hold some hundred bytes a token: few at a time.
        for part in sliced(((t,) for t in texts), size=0, limit=AT_ONCE):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([t for t, in part], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(counts[-1].sum())))
        return np.concatenate(counts), np.concatenate(ids)

    def spaced(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``whole``, of pieces of these many bytes with a space before each: many in one text, told apart by their bytes."""
        groups = [" " + " ".join(pieces[i:i + JOINED]) for i in range(0, len(pieces), JOINED)]
        _, flat = self.whole(groups)
        ends = np.cumsum(self.bytes[flat])
        wanted = np.cumsum(sizes + 1)
        last = np.searchsorted(ends, wanted)
        if len(pieces) and (int(last[-1]) != len(flat) - 1 or (ends[last] != wanted).any()):
            return self.whole([" " + p for p in pieces])
        return np.diff(last + 1, prepend=0), flat

    def looked_up(self, pieces: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit of each piece, ids of each unit, all ids) of distinct pieces as for ``spaced``: only new ones are encoded."""
        place = pc.index_in(pieces, value_set=self.kept.cast(pieces.type))
        old = place.is_valid().to_numpy(zero_copy_only=False)
        new, size = pieces.filter(place.is_null()), sizes[~old]
        counts, flat = self.spaced(new.to_pylist(), size)
        unit = np.empty(len(pieces), np.int64)
        unit[old], unit[~old] = place.drop_null().to_numpy(), len(self.kept) + np.arange(len(new))
        all_counts, all_ids = np.concatenate([self.kept_counts, counts]), np.concatenate([self.kept_ids, flat])
        keep = np.flatnonzero(size <= KEPT_BYTES)[:KEPT_PIECES - len(self.kept)]
        if len(keep):
            self.kept = pa.concat_arrays([self.kept.cast(pieces.type), new.take(pa.array(keep))])
            self.kept_counts = np.concatenate([self.kept_counts, counts[keep]])
            self.kept_ids = np.concatenate([self.kept_ids, stretches(counts, flat, keep)])
        return unit, all_counts, all_ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids) of texts without nulls."""
        n = len(texts)
        cut = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        coded = cut.flatten().dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first = np.zeros(len(which), bool)
        first[starts] = True
        lengths = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        loose = np.array([p.strip() != p for p in distinct], bool)
        doubtful = np.where(first, loose[which], (loose | (lengths == 0))[which])
        certain = np.add.reduceat(doubtful, starts) == 0 if n else np.empty(0, bool)
        for token in self.added:
            certain &= ~pc.match_substring(texts, token).to_numpy(zero_copy_only=False)

        # Units: kept and new distinct pieces, then each certain text's first piece, then each other text whole.
        inner = np.repeat(certain, sizes) & ~first
        used = np.zeros(len(distinct), bool)
        used[which[inner]] = True
        heads = [distinct[w] for w in which[starts[certain]].tolist()]
        rest = [t for t, c in zip(texts.to_pylist(), certain.tolist(), strict=True) if not c] if not certain.all() else []
        place, *found = self.looked_up(coded.dictionary.filter(pa.array(used)), lengths[used])
        words = len(found[0])
        counts, flat = (np.concatenate(x) for x in zip(found, self.whole(heads), self.whole(rest), strict=True))
        units = np.zeros(len(distinct), np.int64)
        units[used] = place
        unit = units[which]
        firsts = np.empty(n, np.int64)
        firsts[certain] = words + np.arange(len(heads))
        firsts[~certain] = words + len(heads) + np.arange(len(rest))
        unit[starts] = firsts
        kept = inner | first
        ids = stretches(counts, flat, unit[kept])
        per = np.where(kept, counts[np.where(kept, unit, 0)], 0) if len(counts) else np.zeros(len(which), np.int64)
        return (np.add.reduceat(per, starts) if n else np.empty(0, np.int64)), ids

    def records(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text and the end id, packed."""
        counts, ids = self.encode(texts)
        data = np.insert(ids, np.cumsum(counts), end_id).astype(f"<u{self.width}").tobytes()
        edges = np.concatenate([[0], np.cumsum(counts + 1)]) * self.width
        return [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
