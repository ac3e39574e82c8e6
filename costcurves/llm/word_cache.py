"""Encoding with the tokenizers library, each distinct piece of text once.

Metaspace models work inside pieces that begin at a single space. A text is
cut there, and pieces already seen are looked up; new ones are encoded by the library in
batches. A text in which a space touches other white space is encoded whole, since its cuts are
not certain.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from itertools import islice
from types import ModuleType

import numpy as np
from tokenizers import Tokenizer

#: Pieces kept by a worker, some 150 bytes each; beyond that the half met first stays.
KEPT = 250_000
#: Bytes of text encoded at once.
AT_ONCE = 1 << 20
#: New pieces in one text for the library.
JOINED = 200


def kept_by_worker(key: object, make: Callable) -> object:
    """``make()``, once for all tasks of a Python worker: what it learned serves the next task."""
    store = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


class CachedWords:
    """Ids of texts as little-endian bytes, ``width`` bytes an id."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        #: None marks a loose piece; texts with one are encoded whole.
        self.cache: dict[str, bytes | None] = {}

    def packed(self, ids) -> bytes:
        return np.asarray(ids, f"<u{self.width}").tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [self.packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, text: str) -> list[str]:
        """The text's pieces at each space."""
        return text.split(" ")

    def loose(self, piece: str) -> bool:
        """Whether the piece brings white space beside a space."""
        return not piece or piece[0].isspace() or piece[-1].isspace()

    def pieces(self, new: list[str]) -> list[bytes]:
        return self.whole(new)

    def encode(self, texts: list[str], end_id: int | None = None) -> list[bytes]:
        end = b"" if end_id is None else end_id.to_bytes(self.width, "little")
        cut = [self.cut(t) for t in texts]
        used = set().union(*cut)
        new = used.difference(self.cache)
        if len(self.cache) + len(new) > KEPT:
            # The pieces met first are the frequent ones.
            self.cache = dict(islice(self.cache.items(), KEPT // 2))
            new = used.difference(self.cache)
        loose = {p for p in new if self.loose(p)}
        self.cache.update(dict.fromkeys(loose))
        sound = list(new - loose)
        self.cache.update(zip(sound, self.pieces(sound), strict=True))
        look = self.cache.__getitem__
        parts = [list(map(look, ps)) for ps in cut]
        rest = iter(self.whole([t for t, ids in zip(texts, parts, strict=True) if None in ids]))
        return [(next(rest) if None in ids else b"".join(ids)) + end for ids in parts]
