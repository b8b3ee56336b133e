"""Texts as UTF-16 code units with the class and the small letter of each unit.

A letter beyond the basic plane is its two units, so that no two letters share a code. Texts are laid out one
after another with a unit 0 between them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

BLOCK_CHARS = 500_000


def text_blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(units, place of each text's first one and of the end, counting the unit after each text to it)."""
    joined = "\0".join([*texts, ""])
    units = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    if int(sizes.sum()) != len(units):
        sizes = np.array([len(t.encode("utf-16-le", "surrogatepass")) // 2 + 1 for t in texts], np.int64)
    return units, np.concatenate([[0], np.cumsum(sizes)])


def small_letters(is_letter: Callable[[str], bool]) -> np.ndarray:
    """For every unit of the basic plane its small letter, or 0 where it is none. Letters whose small form has
    several characters stay as they are."""
    out = np.zeros(1 << 16, np.uint16)
    for i in [*range(0xD800), *range(0xE000, 1 << 16)]:
        c = chr(i)
        if is_letter(c):
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else i
    return out


def codes_of(units: np.ndarray, table: np.ndarray, is_letter: Callable[[str], bool]) -> np.ndarray:
    """Small letters of units, 0 for all else; both units of a letter beyond the basic plane."""
    code = table[units]
    high = np.flatnonzero((units >= 0xD800) & (units < 0xDC00))
    high = high[high + 1 < len(units)]
    if len(high):
        points = 0x10000 + ((units[high].astype(np.uint32) - 0xD800) << 10) + (units[high + 1].astype(np.uint32) - 0xDC00)
        values, at = np.unique(points, return_inverse=True)
        low = np.zeros(len(values), np.uint32)
        for i, v in enumerate(values.tolist()):
            if v < 0x110000 and is_letter(chr(v)):
                c = chr(v).lower()
                low[i] = (ord(c) if len(c) == 1 and ord(c) > 0xFFFF else v) - 0x10000
            else:
                low[i] = 0xFFFFFFFF
        low = low[at]
        some = low != 0xFFFFFFFF
        code[high[some]] = (0xD800 + (low[some] >> 10)).astype(np.uint16)
        code[high[some] + 1] = (0xDC00 + (low[some] & 0x3FF)).astype(np.uint16)
    return code
