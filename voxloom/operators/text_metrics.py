"""Word and character error rate, characters per second, as columns; edit distances run in Arrow batches, many pairs at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _counter():
    """Edit distances of strings or arrays. Nested, so that the functions themselves travel to executors."""

    def matches(a):
        """Where in a something is, as the bits of an integer."""
        places: dict = {}
        for i, x in enumerate(a):
            places.setdefault(x, []).append(i)

        @lru_cache(256)
        def equal(y) -> int:
            bits = bytearray(len(a) // 8 + 1)
            for i in places.get(y, ()):
                bits[i >> 3] |= 1 << (i & 7)
            return int.from_bytes(bits, "little")

        return equal

    def edits(a, b) -> int:
        """One pair, exact, bit-parallel: a column of the square is a pair of integers as long as the longer side, so memory grows with the length only."""
        a, b = (x if isinstance(x, str) else list(x) for x in (a, b))
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        start, end = 0, 0
        while start < len(b) and a[start] == b[start]:
            start += 1
        while end < len(b) - start and a[-1 - end] == b[-1 - end]:
            end += 1
        a, b = a[start : len(a) - end], b[start : len(b) - end]
        n = len(a)
        if not b:
            return n
        equal, full, last, total = matches(a), (1 << n) - 1, 1 << (n - 1), n
        up, down = full, 0  # rows where the distance rises or falls against the row above
        for y in b:
            same = equal(y)
            diagonal = ((((same & up) + up) ^ up) | same | down) & full
            right = down | (full ^ (diagonal | up))
            left = diagonal & up
            total += 1 if right & last else -1 if left & last else 0
            right = ((right << 1) | 1) & full
            up = ((left << 1) & full) | (full ^ (diagonal | right))
            down = right & diagonal
        return total

    def codes(x) -> np.ndarray:
        out = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
        top = int(out.max(initial=0))
        return out.astype(np.uint8) if top < 1 << 8 else out.astype(np.uint16) if top < 1 << 16 else out

    def trimmed(a, b):
        """Codes, longer side first, without common ends; None where a side is empty then, with the distance."""
        if isinstance(a, str):
            a, b = codes(a), codes(b)
        else:
            seen: dict = {}
            a, b = (np.array([seen.setdefault(x, len(seen)) for x in y], np.uint16 if len(a) + len(b) < 1 << 16 else np.uint32) for y in (a, b))
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        other = np.flatnonzero(a[: len(b)] != b)
        start = int(other[0]) if len(other) else len(b)
        a, b = a[start:], b[start:]
        other = np.flatnonzero(a[len(a) - len(b) :][::-1] != b[::-1])
        end = int(other[0]) if len(other) else len(b)
        a, b = a[: len(a) - end], b[: len(b) - end]
        kind = np.promote_types(a.dtype, b.dtype)
        return (a.astype(kind), b.astype(kind)) if len(b) else None, len(a)

    def narrow(a: list, b: list, half: int) -> int:
        """Distance of one pair by the ways that ``banded`` takes. Bit p of a step's integers is the row p - half above the step's own; the last diagonal ends the table."""
        gap = len(a) - len(b)
        equal, full, last, total = matches(a), (1 << gap + 2 * half + 1) - 1, 1 << gap + half, gap
        up, down = full >> half << half, 0
        for j, y in enumerate(b, -half):
            same = (equal(y) >> j if j > 0 else equal(y) << -j) & full
            diagonal = ((((same & up) + up) ^ up) | same | down) & full
            right = down | (full ^ (diagonal | up))
            left = diagonal & up
            if not diagonal & last:
                total += 1
            diagonal >>= 1
            up = left | (full ^ (diagonal | right))
            down = diagonal & right
        return total

    def banded(pairs: list, half: int) -> np.ndarray:
        """Distances by ways that leave the diagonals between 0 and the difference in length by at most ``half`` (even) on either side.

        Anti-diagonal by anti-diagonal, all pairs side by side. Distances are kept modulo 256, since neighbours differ by one at most, and
        each pair's last diagonal is read before it can go round.
        """
        n, m = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
        count, longest, kind = len(pairs), int(n.max()), pairs[0][0].dtype
        rows = (int((n - m).max()) + half + 1) // 2 + half // 2  # of odd diagonals; one more is even, from -half on
        pad = rows + 2
        a, b = np.zeros((longest + 2 * pad, count), kind), np.zeros((longest + 2 * pad, count), kind)
        for p, (x, y) in enumerate(pairs):
            a[pad : pad + len(x), p] = x
            b[longest + pad - len(y) : longest + pad, p] = y[::-1]
        first = np.abs(np.arange(-half, -half + 2 * rows + 1))[:, None].repeat(count, 1).astype(np.uint8)
        even, odd = first[::2].copy(), np.zeros((rows + 2, count), np.uint8)
        odd[1:-1] = first[1::2]
        less, one, two = np.empty((rows + 1, count), np.uint8), np.empty((rows + 1, count), bool), np.empty((rows + 1, count), bool)
        ends, last, each, at = n + m, n - m + half, np.arange(count), 0
        total, before = n - m, (n - m) % 256
        for stop in sorted({*ends.tolist(), *range(400, int(ends.max()), 400)}):
            for s in range(at + 1, stop + 1):
                if s % 2:
                    here, left, right, size, low = odd[1:-1], even[:-1], even[1:], rows, 1 - half
                else:
                    odd[0], odd[-1] = even[0], even[-1]  # nothing comes from beyond the band
                    here, left, right, size, low = even, odd[:-1], odd[1:], rows + 1, -half
                i = (s + low) // 2
                u, v, x, y, z = i - 1 + pad, longest + pad - (s - i), less[:size], one[:size], two[:size]
                np.subtract(here, 1, out=x)
                np.not_equal(left, x, out=y)
                np.not_equal(right, x, out=z)
                np.logical_and(y, z, out=y)
                np.not_equal(a[u : u + size], b[v : v + size], out=z)
                np.logical_and(y, z, out=y)
                np.add(here, y.view(np.uint8), out=here)
            now, at = np.where(last % 2 == 0, even[last // 2, each], odd[np.minimum(last // 2, rows - 1) + 1, each]).astype(np.int64), stop
            total, before = np.where(ends >= stop, total + (now - before) % 256, total), now
        return total

    def distances(pairs: list, share: int) -> list:
        """Exact: a band starts with 1 / share of the longer side and grows until the distance shows that no way outside is shorter. Each batch goes the way that takes the fewest seconds by estimate."""
        out, todo = [None] * len(pairs), []
        for i, (a, b) in enumerate(pairs):
            if a is not None and b is not None:
                rest, out[i] = trimmed(a, b)
                if rest:
                    todo.append((*rest, (len(rest[0]) // share + 8) // 2 * 2, i))

        def width(a, b, half, i) -> int:
            return len(a) - len(b) + 2 * half

        def alone(*pair) -> tuple[float, float]:
            n, m = len(pair[0]), len(pair[1])
            return m * (7.5e-7 + n * 1.1e-11 + width(*pair) * 1.1e-10), m * (8.5e-7 + n * 1.3e-10)  # narrow, edits

        while todo:
            batches: dict = {}
            for t in sorted(todo, key=lambda t: -len(t[0])):
                w = width(*t)
                same = batches.setdefault((t[0].dtype, w.bit_length(), w >> (w.bit_length() - 2)), [[]])
                if same[-1] and (len(t[0]) < 0.75 * len(same[-1][0][0]) or (len(same[-1]) + 1) * max(width(*x) for x in same[-1][:1]) > 1 << 17):
                    same.append([])
                same[-1].append(t)
            todo = []
            for batch in (x for same in batches.values() for x in same):
                half, size = max(t[2] for t in batch), max(width(*t) for t in batch) * len(batch) / 2
                if 2 * len(batch[0][0]) * (5.5e-6 + size * 4e-10) < sum(min(alone(*t)) for t in batch):
                    found = [(d, half) for d in banded([t[:2] for t in batch], half).tolist()]
                else:
                    found = [(narrow(a.tolist(), b.tolist(), h), h) if alone(a, b, h, i)[0] < alone(a, b, h, i)[1] else (edits(a.tolist(), b.tolist()), len(a)) for a, b, h, i in batch]
                for (a, b, _, i), (d, h) in zip(batch, found):
                    if d <= len(a) - len(b) + 2 * h + 1:
                        out[i] = d
                    else:
                        todo.append((a, b, h * 3, i))
        return out

    def series(a: pd.Series, b: pd.Series) -> pd.Series:
        words = next((not isinstance(x, str) for x in a if x is not None), False)
        out, some, size = [], [], 0
        for pair in zip(a, b):
            some.append(pair)
            size += sum(len(x) for x in pair if x is not None)
            if size > 1 << 24:  # bounds what codes and bands take
                out, some, size = out + distances(some, 12 if words else 32), [], 0
        return pd.Series(out + distances(some, 12 if words else 32), dtype="Int64")

    return series


def _edits(a: Column, b: Column) -> Column:
    """Exact edits of whole texts. Called nondeterministic only so that a filter on a rate doesn't compute it a second time."""
    return F.pandas_udf(_counter(), "long").asNondeterministic()(a, b)


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word edits over reference words; null for a reference without words. May exceed 1."""
    r, h = words(reference), words(hypothesis)
    return F.when(F.size(r) > 0, _edits(r, h).cast("double") / F.size(r))


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character edits over reference characters, both stripped; null for an empty reference."""
    r, h = F.trim(reference), F.trim(hypothesis)
    return F.when(F.length(r) > 0, _edits(r, h).cast("double") / F.length(r))


def cps(text: Column, seconds: Column) -> Column:
    """Characters a second; null for no or zero duration."""
    return F.try_divide(F.char_length(text).cast("double"), seconds)
