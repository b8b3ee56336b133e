"""Token ids of whole texts through a cache of their white-space-free pieces.

Both tokenizers used here treat the parts of a text between certain cuts independently, so the ids of a
text are the ids of its pieces one after another. Pieces repeat; each worker keeps the ids of those it has
seen as bytes, joins them, and sends only new pieces to the library, many in one call.
"""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import regex

#: Pieces kept by one worker process (about 200 bytes each); the cache starts afresh when it is full.
KEEP = 1_000_000
#: Longer pieces aren't kept.
LONG = 64


class _Known(dict):
    """Ids by piece; a piece that isn't known yet is noted in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> bytes:
        self.new.append(piece)
        self[piece] = b""
        return b""


class PieceCache:
    """encode_new: ids of pieces, as little-endian bytes; cut: the pieces of a text, in order; keep: pieces kept."""

    def __init__(self, cut: Callable[[str], list[str]], encode_new: Callable[[list[str]], list[bytes]], keep: int = KEEP):
        self.cut, self.encode_new, self.keep, self.known = cut, encode_new, keep, _Known()

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.cut(t) for t in texts]
        if len(self.known) > self.keep:
            self.known = _Known()
        known = self.known
        for p in pieces:
            deque(map(known.__getitem__, p), 0)
        if new := known.new:
            known.new = []
            known.update(zip(new, self.encode_new(new), strict=True))
        out = [b"".join(map(known.__getitem__, p)) for p in pieces]
        for p in new:
            if len(p) > LONG:
                del known[p]
        return out


_NO_SPACE = re.compile("[^ \t\n\r]+").findall
#: Fixed pattern of the tokenizer's own word split; only counts words, and is checked against the library's.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


def _words_in(piece: str) -> int:
    if piece.isalpha() and piece.isascii():
        return 1
    return len(_WORD(unicodedata.normalize("NFC", piece).lower()))


def by_space(tokenizer, dtype: str) -> PieceCache:
    """For tokenizers that never join characters across white space and give white space no id.

    Pieces go to the library many at a time. The library numbers the words of what it gets; a piece's ids are
    those of its words. Where the numbers of words disagree, character offsets tell the pieces apart.
    """
    width = np.dtype(dtype).itemsize

    def encode_new(pieces: list[str]) -> list[bytes]:
        groups = [pieces[i : i + 64] for i in range(0, len(pieces), 64)]
        out: list[bytes] = []
        for i in range(0, len(groups), 64):
            some = groups[i : i + 64]
            for group, found in zip(some, tokenizer.encode_batch([" ".join(g) for g in some], add_special_tokens=False), strict=True):
                raw, words = np.array(found.ids, dtype).tobytes(), found.word_ids
                last = list(accumulate(map(_words_in, group)))
                if words and None not in words and words[-1] + 1 == last[-1]:
                    at = np.searchsorted(np.array(words), np.array([0, *last]))
                else:
                    starts = np.cumsum([0] + [len(p) + 1 for p in group])
                    at = np.searchsorted(np.array([a for a, _ in found.offsets], np.int64), starts) if words else np.zeros(len(starts), int)
                at = (at * width).tolist()
                out += [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out

    return PieceCache(_NO_SPACE, encode_new)
