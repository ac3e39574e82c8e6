"""Operator 8: SentencePiece models encoded and decoded by the tokenizers library.

The model file is a protobuf message, read here by its wire format: pieces with scores and types,
the trainer's model type and the normaliser's flags. From it the tokenizers objects are rebuilt:
the marker for spaces and the dummy prefix as normaliser, unigram scores or BPE merges (a piece's
splits into two pieces, better scores first) as model, byte fallback, and the inverse
as decoder. Batches are encoded by ``threads`` threads of the library.

Parity: every distinct piece of text that a worker encodes, and every text that it encodes whole, is also
encoded by the sentencepiece library; ``parity`` tells whether the ids agree for all pieces of a row's text.

Defined cases: a null text reads as empty and has no ids. Characters without a piece become byte
pieces, or the unknown id where the model has no byte pieces. Equal rows get equal results, null ids
pass through. Very long texts are encoded whole. An empty table gives an empty result. Only the id and text
columns are read; other columns named like the results are left out.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from .common import trimmed, whole_text
from .slice_bpe import text_slices
from .word_cache import JOINED, KEPT, CachedWords, kept_by_worker

MARK = "▁"
THREADS = 2
#: Bytes of text encoded at once: their words as Python objects take some fifty times that.
SLICE = 1 << 18
# Numbers of the message's fields and of its enumerations.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK = 3, 35
NAME, CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protobuf message: numbers of variable length, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        if kind not in (1, 2, 5) or at + size > len(data):
            raise ValueError("not a protobuf message of a model")
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True


def parsed(data: bytes) -> Model:
    model = Model()
    for f, value in message(data):
        inner = dict(message(value)) if f in (PIECES, TRAINER, NORMALISER) else {}
        if f == PIECES:
            score = struct.unpack("<f", inner.get(PIECE_SCORE, b"\0\0\0\0"))[0]
            model.pieces.append((inner[PIECE_TEXT].decode(), score, inner.get(PIECE_TYPE, NORMAL)))
        elif f == TRAINER:
            model.kind = inner.get(MODEL_TYPE, UNIGRAM)
            model.byte_fallback = bool(inner.get(BYTE_FALLBACK, 0))
        elif f == NORMALISER:
            model.charsmap = inner.get(CHARSMAP, b"")
            model.dummy_prefix = bool(inner.get(DUMMY_PREFIX, 1))
            model.remove_spaces = bool(inner.get(REMOVE_SPACES, 1))
            model.escape_spaces = bool(inner.get(ESCAPE_SPACES, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"models of type {model.kind} are not supported")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs that join to a piece, in the order in which SentencePiece would join them."""
    score = {p: s for p, s, t in model.pieces if t in (NORMAL, USER)}
    found = []
    for piece, s in score.items():
        for i in range(1, len(piece)):
            if piece[:i] in score and piece[i:] in score:
                found.append((-s, piece[:i], piece[i:]))
    order = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    found.sort(key=lambda m: (m[0], order[m[1]], order[m[2]]))
    return [(a, b) for _, a, b in found]


def rebuilt(model: Model) -> Tokenizer:
    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == UNIGRAM:
        # Names of control pieces are no text: written like this none is found in one.
        core = models.Unigram([(p if t in (NORMAL, USER, BYTE) else "\0" + p, s) for p, s, t in model.pieces], unknown,
                              model.byte_fallback)
    else:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges(model),
                          unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        decoders.Strip(" ", 1 if model.dummy_prefix else 0, 0)])
    return tokenizer


class SpmWords(CachedWords):
    """Pieces lose the space before them, which the dummy prefix gives back."""

    def __init__(self, data: bytes):
        self.model = parsed(data)
        super().__init__(rebuilt(self.model))
        self.other = SentencePieceProcessor(model_proto=data)
        #: Pieces and whole texts on which the two libraries differ.
        self.bad: set[str] = set()
        self.marked = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        self.texts: dict[bytes, str] = {}
        inside = re.compile(f"[^{MARK}]{MARK}")
        #: Whether texts may be cut: no piece reaches over a space that follows another character.
        self.cuts = self.model.dummy_prefix and self.model.escape_spaces and not any(
            inside.search(p) for p, _, t in self.model.pieces if t in (NORMAL, USER))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = super().whole(texts)
        want = self.other.encode(texts, num_threads=1)
        self.bad.update(t for t, a, b in zip(texts, found, want, strict=True) if a != self.packed(b))
        return found

    def cut(self, text: str) -> list[str]:
        return super().cut(text) if self.cuts else [""]

    def pieces(self, new: list[str]) -> list[bytes]:
        """Words are encoded many in one text, by both libraries, and told apart by their marks."""
        found: dict[str, bytes | None] = {p: None for p in new}
        groups = [new[i:i + JOINED] for i in range(0, len(new), JOINED)]
        joined = [" ".join(g) for g in groups]
        ours = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        for group, e, want in zip(groups, ours, self.other.encode(joined, num_threads=1), strict=True):
            ids = np.array(e.ids)
            starts = np.flatnonzero(self.marked[ids])
            if e.ids == want and len(starts) == len(group) and starts[0] == 0:
                packed, edges = self.packed(ids), [*(starts * self.width).tolist(), len(ids) * self.width]
                found.update((p, packed[a:b]) for p, a, b in zip(group, edges, edges[1:]))
        left = [p for p, ids in found.items() if ids is None]
        found.update(zip(left, self.whole(left), strict=True))
        return list(found.values())

    def parity(self, text: str) -> bool:
        """Whether both libraries agree on all pieces of an encoded text."""
        return not self.bad or (text not in self.bad and self.bad.isdisjoint(self.cut(text)))

    def plain(self, encoded: list[bytes]) -> list[str]:
        return self.tokenizer.decode_batch([np.frombuffer(e, f"<u{self.width}").tolist() for e in encoded],
                                           skip_special_tokens=False)

    def words_of(self, new: list[bytes]) -> list[str]:
        """Decoded words, many in one text where their spaces tell them apart."""
        groups = [new[i:i + JOINED] for i in range(0, len(new), JOINED)]
        out: list[str] = []
        for group, text in zip(groups, self.plain([b"".join(g) for g in groups]), strict=True):
            # The first word of a text may begin without a mark; it cannot stand among others.
            marks = self.marked[np.frombuffer(b"".join(w[:self.width] for w in group), f"<u{self.width}")]
            words = text.split(" ")
            out += words if len(words) == len(group) == marks.sum() else self.plain(group)
        return out

    def decode(self, encoded: list[bytes]) -> list[str]:
        """Texts of ids. A word, from a piece with the mark to the next, is decoded by the library once."""
        if not self.cuts:
            return self.plain(encoded)
        cut = []
        for e in encoded:
            ids = np.frombuffer(e, f"<u{self.width}")
            edges = np.flatnonzero(self.marked[ids]) * self.width
            edges = [0, *edges[edges > 0].tolist(), len(e)]
            cut.append([e[a:b] for a, b in zip(edges, edges[1:])])
        used = {w for ws in cut for w in ws}
        new = list(used.difference(self.texts))
        if len(self.texts) + len(new) > KEPT:
            self.texts = dict(islice(self.texts.items(), KEPT // 2))
            new = list(used.difference(self.texts))
        self.texts.update(zip(new, self.words_of(new), strict=True))
        # The decoder drops the space of a word's mark; between words it is put back.
        return [" ".join(map(self.texts.__getitem__, ws)) for ws in cut]


def encoded(docs: DataFrame, model: bytes, threads: int = THREADS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded, round_trip, parity): ids as an array, the text decoded from them, whether it is
    the text encoded, agreement with sentencepiece."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    key = ("spm", zlib.crc32(model), len(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        words = kept_by_worker(key, lambda: SpmWords(model))
        # Slices are cut before their texts become Python strings.
        for rows in text_slices(batches, 1, SLICE):
            texts = rows.column(1).to_pylist()
            found = words.encode(texts)
            ids = [np.frombuffer(e, f"<u{words.width}").astype(np.int32) for e in found]
            offsets = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
            decoded = words.decode(found)
            same = [t == d for t, d in zip(texts, decoded, strict=True)]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                pa.array(decoded), pa.array(same), pa.array([words.parity(t) for t in texts])],
                names=["doc_id", "ids", "decoded", "round_trip", "parity"])

    return rows.mapInArrow(trimmed(run, key), f"doc_id {kind}, ids array<int>, decoded string, round_trip boolean, parity boolean")
