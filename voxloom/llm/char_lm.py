"""Interpolated Kneser-Ney models over the characters of words, one per label, in sorted hash arrays.

A text is its words: runs of letters, lower-cased. A word is predicted letter by letter and then its end, from
the letters before it in the word. An n-gram of 16-bit character codes packs into one 64-bit key, the latest
character in the low bits; code 0 stands before the first letter and for the end. Letters beyond the basic plane are
two codes (``letters``).

``count_grams`` counts the longest n-grams of all texts on the executors (summed in each task before the
shuffle); all lower orders follow from the distinct ones. ``Models`` holds for each order one sorted key array
for all labels with a row of log-probabilities, and for each context a row of back-off weights.

The arrays are broadcast. Where n-grams times labels exceed ``LIMIT``, ``SparseModels`` holds for each key only
the labels that it was counted for; back-off gives the others when a text is scored. The probabilities are the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, let_go, materialise, ship
from .letters import codes_of, laid_out, small_letters, text_blocks

U = np.uint64
ORDER = 4
#: N-grams times labels above which models are sparse.
LIMIT = 24_000_000
#: Distinct n-grams that a task holds before it passes them on.
HELD = 1_000_000
#: Log-probabilities (characters times labels) that are held at once.
CELLS = 4_000_000


@lru_cache(1)
def letter_codes() -> np.ndarray:
    return small_letters(str.isalpha)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, texts they are from) of all predicted characters, in order."""
    units, bounds = laid_out(texts)
    code = codes_of(units, letter_codes(), str.isalpha)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))
    keep = code != 0
    keep[1:] |= keep[:-1]  # the end of a word, too; the unit after a text ends its last word
    code, owner = code[keep], owner[keep]
    n = len(code)
    key = code.astype(U)
    live = np.ones(n, bool)
    for back in range(1, ORDER):
        prior = np.zeros(n, np.uint16)
        prior[back:] = code[:-back] if back < n else code[:0]
        live &= prior != 0
        key |= np.where(live, prior, 0).astype(U) << U(16 * back)
    return key, owner


def count_grams(docs: DataFrame, label: str, text: str) -> DataFrame:
    """(label, gram, n) over all rows; rows with a null label or text count for nothing."""
    ship(docs.sparkSession)

    def flush(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for name, parts in held.items():
            key, n = _merge(parts)
            for i in range(0, len(key), 200_000):
                some = key[i : i + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some.view(np.int64)), pa.array(n[i : i + 200_000])], ["label", "gram", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            labels, texts = batch.column("label").to_pylist(), batch.column("text")
            for name in sorted(set(labels)):
                own = texts.filter(pa.array([x == name for x in labels])).to_pylist()
                for a, b in text_blocks(own):
                    key, n = np.unique(grams(own[a:b])[0], return_counts=True)
                    parts = held.setdefault(name, [])
                    parts.append((key, n.astype(np.int64)))
                    size += len(key)
                    if size > HELD:
                        held = {k: [_merge(v)] for k, v in held.items()}
                        size = sum(len(v[0][0]) for v in held.values())
                        if size > HELD // 2:
                            yield from flush(held)
                            held, size = {}, 0
        yield from flush(held)

    rows = docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def fit(counts: DataFrame) -> Models:
    """Models from the table of count_grams."""
    counts = materialise(counts, "grams")
    found = counts.toArrow()
    discard(counts)
    coded = found["label"].dictionary_encode().combine_chunks()
    names, label = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    gram, n = found["gram"].to_numpy().view(U), found["n"].to_numpy()
    order = np.lexsort((gram, label))
    gram, n, bounds = gram[order], n[order].astype(np.float64), np.searchsorted(label[order], np.arange(len(names) + 1))
    per = {name: (gram[bounds[i] : bounds[i + 1]], n[bounds[i] : bounds[i + 1]]) for i, name in enumerate(names)}
    labels = sorted(names)
    return (SparseModels if len(gram) * len(labels) > LIMIT else Models)(labels, ORDER, per)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, found) of wanted in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _discounted(own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of one label's keys, their back-off weights, and for each key the place of its context and its discounted share."""
    ones, twos = (n == 1).sum(), (n == 2).sum()
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    context, start = np.unique(own >> U(16), return_index=True)
    total = np.add.reduceat(n, start) if len(own) else n
    kinds = np.diff(np.append(start, len(own)))
    of, _ = _find(context, own >> U(16))
    return context, discount * kinds / total, of, np.maximum(n - discount, 0) / (total[of] if len(own) else 1)


class Models:
    """Per order from the longest: sorted keys with log2-probabilities per label, sorted contexts with log2 back-off weights."""

    def __init__(self, labels: list[str], order: int, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.labels, self.order = labels, order
        grams_by = {order: counts}
        for k in range(order - 1, 0, -1):  # continuation counts: distinct longer n-grams that end so
            mask = U((1 << (16 * k)) - 1)
            grams_by[k] = {}
            for name, (keys, _) in grams_by[k + 1].items():
                short, n = np.unique(keys & mask, return_counts=True)
                grams_by[k][name] = (short, n.astype(np.float64))
        union = {k: np.unique(np.concatenate([g[0] for g in by.values()])) if by else np.zeros(0, U) for k, by in grams_by.items()}
        symbols = max(2, len(union.get(1, ())) + 1)
        self.floor = -np.log2(symbols)
        self.fill(grams_by, union, symbols)

    def fill(self, grams_by: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]], union: dict[int, np.ndarray], symbols: int) -> None:
        labels = self.labels
        lower = None
        self.levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in range(1, self.order + 1):
            keys, contexts = union[k], np.unique(union[k] >> U(16))
            prob, back = np.zeros((len(keys), len(labels))), np.ones((len(contexts), len(labels)))
            for j, name in enumerate(labels):
                own = grams_by[k][name][0]
                context, weight, _, share = _discounted(*grams_by[k][name])
                at, _ = _find(contexts, context)
                back[at, j] = weight
                at, _ = _find(keys, own)
                prob[at, j] = share
            if k == 1:
                prob += back[0] / symbols if len(contexts) else 0
                base = (back[0] if len(contexts) else np.ones(len(labels))) / symbols
                self.unseen = np.log2(base).astype(np.float32)
            else:
                context_at, _ = _find(contexts, keys >> U(16))
                below_at, _ = _find(union[k - 1], keys & U((1 << (16 * (k - 1))) - 1))
                prob += back[context_at] * lower[below_at]
            lower = prob
            self.levels[k] = (keys, np.log2(np.maximum(prob, 1e-300)).astype(np.float32), contexts, np.log2(np.maximum(back, 1e-300)).astype(np.float32))

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """log2-probability of each key's last character under each label."""
        keys = keys & U((1 << (16 * self.order)) - 1) if self.order < 4 else keys
        out = np.zeros((len(keys), len(self.labels)), np.float32)
        rest = np.arange(len(keys))
        for k in range(self.order, 0, -1):
            own_keys, prob, contexts, back = self.levels[k]
            short = keys[rest] & U((1 << (16 * k)) - 1) if k < 4 else keys[rest]
            at, found = _find(own_keys, short)
            out[rest[found]] += prob[at[found]]
            rest, short = rest[~found], short[~found]
            if not len(rest):
                return out
            if k > 1:
                at, found = _find(contexts, short >> U(16))
                out[rest[found]] += back[at[found]]
        out[rest] += self.unseen
        return out

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of log2-probabilities per label, number of predicted characters) of each text."""
        sums, sizes = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts), np.int64)
        for a, b in text_blocks(texts):
            keys, owner = grams(texts[a:b])
            if not len(keys):
                continue
            step = max(1, CELLS // max(1, len(self.labels)))
            for i in range(0, len(keys), step):
                logs, of = self.log2(keys[i : i + step]), owner[i : i + step]
                for j in range(len(self.labels)):
                    sums[a:b, j] += np.bincount(of, logs[:, j], b - a)
            sizes[a:b] = np.bincount(owner, minlength=b - a)
        return sums, sizes


class SparseModels(Models):
    """The same models, per order with the labels of each key and context only: sorted keys, where each one's entries start, their labels and log2 values."""

    def fill(self, grams_by: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]], union: dict[int, np.ndarray], symbols: int) -> None:
        probs, backs = {k: [] for k in grams_by}, {k: [] for k in grams_by}
        self.unseen = np.zeros(len(self.labels), np.float32)
        for j, name in enumerate(self.labels):
            below = None
            for k in range(1, self.order + 1):
                own = grams_by[k][name][0]
                context, weight, of, share = _discounted(*grams_by[k][name])
                if k == 1:
                    base = weight[0] / symbols
                    self.unseen[j] = np.log2(base)
                    prob = share + base
                else:
                    at, _ = _find(grams_by[k - 1][name][0], own & U((1 << (16 * (k - 1))) - 1))
                    prob = share + weight[of] * below[at]
                below = prob
                probs[k].append((own, np.log2(np.maximum(prob, 1e-300)).astype(np.float32)))
                backs[k].append((context, np.log2(np.maximum(weight, 1e-300)).astype(np.float32)))
        self.levels = {k: (*_by_key(probs.pop(k)), *_by_key(backs.pop(k))) for k in range(1, self.order + 1)}

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """log2-probability of each key's last character under each label."""
        keys, back_to = np.unique(keys, return_inverse=True)
        out, open_ = np.zeros((len(keys), len(self.labels)), np.float32), np.ones((len(keys), len(self.labels)), bool)
        rest = np.arange(len(keys))
        for k in range(self.order, 0, -1):
            own_keys, starts, labels, prob, contexts, context_starts, context_labels, back = self.levels[k]
            short = keys[rest] & U((1 << (16 * k)) - 1) if k < 4 else keys[rest]
            row, entry = _entries(own_keys, starts, short)
            row, label = rest[row], labels[entry]
            new = open_[row, label]
            out[row[new], label[new]] += prob[entry[new]]
            open_[row, label] = False
            live = open_[rest].any(1)
            rest, short = rest[live], short[live]
            if not len(rest):
                return out[back_to]
            if k > 1:
                row, entry = _entries(contexts, context_starts, short >> U(16))
                row, label = rest[row], context_labels[entry]
                new = open_[row, label]
                out[row[new], label[new]] += back[entry[new]]
        return (out + np.where(open_, self.unseen, np.float32(0)))[back_to]


def _by_key(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct sorted keys, starts of their entries, labels, values) of one (keys, values) a label."""
    keys = np.concatenate([p[0] for p in parts])
    label = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
    order = np.argsort(keys, kind="stable")
    distinct, starts = np.unique(keys[order], return_index=True)
    return distinct, np.append(starts, len(keys)), label[order], np.concatenate([p[1] for p in parts])[order]


def _entries(keys: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in wanted, entry) of all entries of the wanted keys."""
    at, found = _find(keys, wanted)
    row, at = np.flatnonzero(found), at[found]
    n = starts[at + 1] - starts[at]
    first = np.repeat(starts[at] - (np.cumsum(n) - n), n)
    return np.repeat(row, n), first + np.arange(len(first))
