"""Words of UTF-8 texts as arrays: every step runs over a whole batch of texts at once.

A word is a maximal run of bytes that are not separators; A-Z are lower-cased first. All separators are
ASCII, so byte runs are the same as code-point runs. Texts are laid out one after another with a separator
between them, and every word gets a 64-bit hash: the sum of random byte codes times powers of an odd
number, taken as a difference of prefix sums, then mixed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK_BYTES = 500_000
_R = U(0x9E3779B97F4A7C15)
_Q = U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@lru_cache(4)
def _powers(n: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, r, U)]), dtype=U)
        down = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, pow(r, -1, 2**64), U)]), dtype=U)
    return up, down


def powers(n: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    return _powers(size, int(r))


@lru_cache(1)
def _codes() -> np.ndarray:
    """Random odd-mixed codes of the 256 bytes, A-Z as a-z."""
    codes = mix(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))
    codes[65:91] = codes[97:123]
    return codes


#: Separators of the two kinds of words used here, as tables over the 256 bytes.
def spaces_table() -> np.ndarray:
    """Space and \\t to \\r separate."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def non_alnum_table() -> np.ndarray:
    """Every ASCII byte that is neither a digit nor a letter separates."""
    t = np.zeros(256, bool)
    t[:128] = True
    t[0x30:0x3A] = False
    t[0x61:0x7B] = False
    t[0x41:0x5B] = False
    return t


class Block:
    """Words of consecutive texts: hash and byte range of each word; first word and first byte of each text."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, hashes: np.ndarray, text_at: np.ndarray):
        self.raw, self.starts, self.ends, self.first, self.hashes, self.text_at = raw, starts, ends, first, hashes, text_at

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes().lower()


def blocks(column: pa.Array, separators: np.ndarray):
    """Yield (first row, end row, Block) over a string column, in blocks of about BLOCK_BYTES; null: no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = ~np.asarray(column.is_valid()) if column.null_count else None
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, _block(data, offsets[row : end + 1], separators, None if null is None else null[row:end])
        row = end


def _block(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, null: np.ndarray | None) -> Block:
    base = int(offsets[0])
    raw = data[base : int(offsets[-1])]
    lengths = np.diff(offsets)
    if null is not None and null.any():
        lengths = np.where(null, 0, lengths)  # what lies under a null isn't text
    if int(lengths.sum()) != len(raw):
        raw = np.concatenate([raw[o - base : o - base + k] for o, k in zip(offsets[:-1], lengths, strict=True)] or [raw[:0]])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    n = len(raw)
    inside = ~separators[raw]
    if n:
        left = np.empty(n, bool)
        left[0] = True
        left[1:] = ~inside[:-1]
        right = np.empty(n, bool)
        right[-1] = True
        right[:-1] = ~inside[1:]
        cut = bounds[1:-1]
        left[cut[cut < n]] = True
        right[cut[cut > 0] - 1] = True
        starts = np.flatnonzero(inside & left)
        ends = np.flatnonzero(inside & right) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        up, down = powers(n + 1, int(_R))
        sums = np.zeros(n + 1, U)
        np.cumsum(_codes()[raw] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
    return Block(raw, starts, ends, np.searchsorted(starts, bounds), hashes, bounds)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive hashes."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        up, down = powers(n + 1, int(_Q))
        sums = np.zeros(n + 1, U)
        np.cumsum(hashes * up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[: n - k + 1] + U(k))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles of one text; with fewer words, the whole sequence is one; without, none."""
    if not len(hashes):
        return np.zeros(0, U)
    return np.unique(windows(hashes, min(k, len(hashes))))
