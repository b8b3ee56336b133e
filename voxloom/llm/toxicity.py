"""Toxicity by a noisy channel: restore obfuscated words, then score the restored text.

Restoring. Suspicious spans of a text are tokens that mix letters with signs or digits that can stand for
letters, letters repeated three times and more, and single letters strung out by spaces, dots, dashes, stars or
underscores. Such a span becomes a lattice: every character may be itself or a letter that it stands for, at a
cost; a run of one letter may stand for one or two; separators of strung-out letters fall away. Viterbi decoding
under a character model (interpolated Kneser-Ney over words, ``char_lm``, learned from all texts) gives the
likeliest letters. Everything else stays as it is.

Scoring. Features are the words of the restored text and their beginnings of 4 to 6 letters. They are counted
over all training texts, toxic and clean, in one pass. Words that only copies of a toxic text share would
look toxic too, so a feature counts as often as it stands between different neighbours. A feature is taken if
so many of its occurrences are toxic that chance wouldn't do it among all features tested, and few are clean.
A text's evidence is the sum of log odds over its taken features; the probability of toxicity with and without
evidence is calibrated on the training rows.

Cases: null and empty texts score as texts without evidence; labels other than 0 and 1 or null aren't learned
from; a document with several labels is learned once for each; without toxic training rows everything scores
the smoothed base rate; repeated rows are scored alike; other columns pass through whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytewords as bw
from .char_lm import Models, count_grams, fit
from .common import as_row, discard, join_small, materialise, named, part_of, row_schema, ship, table
from .language_id import fold
from .letters import codes_of, laid_out, small_letters, text_blocks

#: Letters that signs and digits commonly stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Signs that also end words or stand between them count only before a letter.
_WEAK = "!|+("
_SIGNS = "".join(re.escape(c) for c in STANDS_FOR if c not in _WEAK)
_SIGN = rf"(?:[{_SIGNS}]|[{re.escape(_WEAK)}](?=[^\W\d_]))"
#: A token of letters and such signs with both kinds in it and a letter or sign-in-word at its end; a run of three; a string of single letters.
_MIXED = rf"(?<![^\W_])(?=[^\W\d_]*{_SIGN})(?={_SIGN}*[^\W\d_])(?:[^\W\d_]|{_SIGN})+"
_RUN = r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*"
_STRUNG = r"(?<![^\W_])[^\W\d_](?:[ .\-*_]{1,2}[^\W\d_]){2,}(?![^\W_])"
SUSPICIOUS = re.compile(f"(?P<strung>{_STRUNG})|(?P<run>{_RUN.replace(chr(92) + '1', '(?P=r)').replace('([^', '(?P<r>[^', 1)})|(?P<mixed>{_MIXED})", re.IGNORECASE)
#: log2 costs of reading a sign as a letter, of keeping a sign as it is, and of one letter standing for a run.
AS_LETTER, AS_SIGN, AS_RUN = 1.0, 6.0, 0.5

#: Toxic texts that a candidate is in at least; share of toxic ones among its texts; chance of any false feature.
LEAST, PRECISION, CHANCE = 4, 0.8, 0.01
#: Restored tokens that a worker keeps; a full memory starts afresh.
CACHED = 150_000
#: Features whose counts a task holds before it passes them on.
HELD = 1_000_000
BEGINNINGS = (4, 5, 6)
U = np.uint64
_BASE = 0x9E3779B97F4A7C15


class Restorer:
    """Viterbi decoding of suspicious spans; decoded spans are remembered. Capitals read like small letters."""

    def __init__(self, model: Models):
        self.model, self.known, self.logs = model, {}, {}

    def log2(self, context: str, letter: str) -> float:
        """log2-probability of a letter after the last three of its word; '' is the word's end."""
        key = 0
        for c in (context + (letter or "\0"))[-4:]:
            key = key << 16 | (min(ord(c), 0xFFFF) if c != "\0" else 0)
        if key not in self.logs:
            if len(self.logs) > 100_000:
                self.logs.clear()
            self.logs[key] = float(self.model.log2(np.array([key], np.uint64))[0, 0]) if self.model.labels else -5.0
        return self.logs[key]

    def restore(self, text: str) -> str:
        return SUSPICIOUS.sub(self._span, text)

    def _span(self, found: re.Match) -> str:
        span = found[0]
        key = (found.lastgroup if found.lastgroup != "r" else "run", span)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[key] = self.decode(re.sub(r"[ .\-*_]", "", span) if found["strung"] else span)
        return self.known[key]

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each run of one character, what it may be and at what cost."""
        out = []
        for run in re.finditer(r"(.)\1*", token.lower(), re.S):
            c, n = run[1], len(run[0])
            letters = [(x, AS_LETTER) for x in STANDS_FOR.get(c, "")]
            own = [(c, AS_SIGN if letters else 0.0)]
            ways = []
            for letter, cost in own + letters:
                if n <= 2:
                    ways.append((letter * n, cost * n))
                if n == 2 and letters and letter != c:
                    ways.append((letter, cost + AS_RUN))
                if n >= 3:
                    ways += [(letter, cost + AS_RUN), (letter * 2, cost + 2 * AS_RUN)]
            out.append(ways)
        return out

    def decode(self, token: str) -> str:
        """The likeliest reading."""
        beams = {"": (0.0, None)}  # last three letters -> (cost, reading as linked pairs)
        for ways in self.lattice(token):
            after: dict[str, tuple] = {}
            for context, (cost, path) in beams.items():
                for piece, extra in ways:
                    now, total = context, cost + extra
                    for c in piece:
                        if c.isalpha():
                            total -= self.log2(now, c)
                            now = (now + c)[-3:]
                        else:
                            total -= self.log2(now, "") if now else 0.0
                            now = ""
                    if now not in after or total < after[now][0]:
                        after[now] = (total, (path, piece))
            beams = after
        end = min(beams.items(), key=lambda b: (b[1][0] - (self.log2(b[0], "") if b[0] else 0.0), b[0]))
        parts, path = [], end[1][1]
        while path:
            path, piece = path
            parts.append(piece)
        return "".join(reversed(parts))


_IS_LETTER = re.compile(r"[^\W\d_]\Z").match
LETTER, ALNUM, SIGN, WEAK, SEPARATOR, SPACE = 1, 2, 4, 8, 16, 32


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Small letters and classes of the units of the basic plane."""
    low, kinds = small_letters(lambda c: bool(_IS_LETTER(c))), np.zeros(1 << 16, np.uint8)
    kinds[low > 0] |= LETTER | ALNUM
    for i in [*range(0xD800), *range(0xE000, 1 << 16)]:
        c = chr(i)
        kinds[i] |= ALNUM * c.isalnum() | SPACE * (c.isspace() or not i)
    for c in STANDS_FOR:
        kinds[ord(c)] |= SIGN | WEAK * (c in _WEAK)
    for c in " .-*_":
        kinds[ord(c)] |= SEPARATOR
    return low, kinds


@dataclass
class Read:
    """Restored words of a block of texts, in order: the number of each one's text, its hash, and the hashes of its
    beginnings (a column for each of BEGINNINGS, 0 where the word isn't longer)."""

    start: int
    texts: int
    text: np.ndarray
    word: np.ndarray
    beginnings: np.ndarray

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, word) pairs, words as numbers into the distinct ones, and places of these."""
        _, at, of = np.unique(self.word, return_index=True, return_inverse=True)
        pair = np.unique(self.text.astype(np.int64) << 32 | of)
        return pair >> 32, pair & 0xFFFFFFFF, at


def small_codes(units: np.ndarray) -> np.ndarray:
    return codes_of(units, _tables()[0], lambda c: bool(_IS_LETTER(c)))


def hashed_words(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, hashes of the beginnings) of all words: runs of small letters."""
    edge = np.diff((code != 0).astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    with np.errstate(over="ignore"):
        up, down = bw.powers(len(code) + 1, _BASE)
        sums = np.zeros(len(code) + 1, U)
        np.cumsum((code.astype(U) + U(1)) * up[: len(code)], out=sums[1:])
        word = bw.mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))
        beginnings = np.zeros((len(start), len(BEGINNINGS)), U)
        for j, k in enumerate(BEGINNINGS):
            longer = np.flatnonzero(end - start > k)
            at = start[longer]
            beginnings[longer, j] = bw.mix((sums[at + k] - sums[at]) * down[at] + U(k + (1 << 32)))
    return start, word, beginnings


def feature_keys(words: list[str]) -> list[list[int]]:
    """Hashes of each word and of its beginnings, in order of length of the latter."""
    units, _ = laid_out(words)
    _, word, beginnings = hashed_words(small_codes(units))
    return [[int(w), *(int(x) for x in b if x)] for w, b in zip(word, beginnings, strict=True)]


class Reader:
    """Words of restored texts, a block at a time. Only tokens with something suspicious in them are restored (and
    remembered), and whole texts where letters are strung out over several tokens; all other words are hashed as they
    stand. Words are 64-bit hashes; two words share one with a probability of 2^-64."""

    def __init__(self, restorer: Restorer):
        self.restorer, self.known = restorer, {}

    def read(self, column: pa.Array) -> Iterator[Read]:
        texts = [t or "" for t in column.to_pylist()]
        for a, b in text_blocks(texts):
            yield self._block(texts[a:b], a)

    def _block(self, texts: list[str], first: int) -> Read:
        units, bounds = laid_out(texts)
        kinds = _tables()[1][units]
        code = small_codes(units)
        far = np.flatnonzero((code != 0) & (kinds == 0))
        kinds[far] = LETTER | ALNUM
        start, word, beginnings = hashed_words(code)
        text = np.searchsorted(bounds, start, "right") - 1
        tokens, whole = self._suspicious(units, kinds, code, bounds)
        # words of suspicious tokens and texts give way to restored ones at the same place
        gone = np.zeros(len(start), bool)
        places, strings = [], []
        for t in whole:
            gone |= text == t
            places.append(int(bounds[t]))
            strings.append(self.restorer.restore(texts[t]))
        for x, y in tokens:
            gone[np.searchsorted(start, x) : np.searchsorted(start, y)] = True
            token = units[x:y].tobytes().decode("utf-16-le", "replace")
            found = self.known.get(token)
            if found is None:
                if len(self.known) > CACHED:
                    self.known.clear()
                found = self.known[token] = self.restorer.restore(token)
            places.append(x)
            strings.append(found)
        if not strings:
            return Read(first, len(texts), text, word, beginnings)
        more, ends = laid_out(strings)
        at, more_words, more_beginnings = hashed_words(small_codes(more))
        place = np.array(places)[np.searchsorted(ends, at, "right") - 1]
        stay = np.flatnonzero(~gone)
        place = np.concatenate([start[stay], place])
        order = np.argsort(place, kind="stable")
        place = place[order]
        return Read(first, len(texts), np.searchsorted(bounds, place, "right") - 1, np.concatenate([word[stay], more_words])[order], np.concatenate([beginnings[stay], more_beginnings])[order])

    def _suspicious(self, units: np.ndarray, kinds: np.ndarray, code: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
        """Ranges of tokens that hold something for the restorer, and numbers of texts to be restored whole."""
        letter, sign = (kinds & LETTER) > 0, (kinds & SIGN) > 0
        strong = sign & ((kinds & WEAK) == 0)
        odd = (letter[:-1] & strong[1:]) | (sign[:-1] & letter[1:])
        odd[:-1] |= letter[:-2] & (code[:-2] == code[1:-1]) & (code[1:-1] == code[2:])
        edge = np.diff(((kinds & ALNUM) > 0).astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = end - start
        single = letter[start] & ((size == 1) | ((size == 2) & (units[start] >= 0xD800) & (units[start] < 0xDC00)))
        separator, space = (kinds & SEPARATOR) > 0, (kinds & SPACE) > 0
        gap = start[1:] - end[:-1]
        after, before = end[:-1], start[1:] - 1
        link = single[:-1] & single[1:] & (gap <= 2) & separator[after] & separator[before]
        chained = np.zeros(len(link) + 2, bool)
        two = link[:-1] & link[1:]
        chained[: len(two)] |= two
        chained[1 : len(two) + 1] |= two
        at = np.flatnonzero(chained[: len(link)])
        across = space[after[at]] | space[before[at]]
        whole = np.unique(np.searchsorted(bounds, after[at[across]], "right") - 1)
        odd[after[at[~across]]] = True
        odd = np.flatnonzero(odd)
        if len(whole) and len(odd):
            odd = odd[~np.isin(np.searchsorted(bounds, odd, "right") - 1, whole)]
        spaces = np.flatnonzero(space)
        to = np.unique(np.searchsorted(spaces, odd))
        begin = np.where(to > 0, spaces[to - 1] + 1, 0)
        return list(zip(begin.tolist(), spaces[to].tolist(), strict=True)), whole.tolist()

    def words(self, text: str | None) -> set[int]:
        """Hashes of the words of one text."""
        return {int(w) for r in self.read(pa.array([text], pa.string())) for w in r.word}


@dataclass
class Scorer:
    """Log odds of the features that were taken, by hash in ascending order, and calibrated probabilities."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.0
    slope: float = 1.0

    def has(self, word: str) -> bool:
        """Whether the word or one of its beginnings was taken."""
        return any(np.isin(np.array(k, U), self.keys).any() for k in feature_keys([word]))

    def score(self, totals: np.ndarray) -> np.ndarray:
        """Probabilities of texts with so much evidence."""
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * np.asarray(totals, float), -40.0, 40.0)))

    def totals(self, read: Read) -> np.ndarray:
        """Evidence of each text: log odds of its distinct words, a word counting with its heaviest feature."""
        if not len(self.keys):
            return np.zeros(read.texts)
        weight = np.zeros(len(read.word))
        for keys in (read.word, *read.beginnings.T):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            weight = np.maximum(weight, np.where(self.keys[at] == keys, self.weights[at], 0.0))
        some = np.flatnonzero(weight > 0)
        order = np.lexsort((read.word[some], read.text[some]))
        some = some[order]
        text, word = read.text[some], read.word[some]
        once = np.ones(len(some), bool)
        once[1:] = (text[1:] != text[:-1]) | (word[1:] != word[:-1])
        return np.bincount(text[once], weight[some[once]], read.texts)


def _frequencies(rows: DataFrame, model) -> DataFrame:
    """(feature, t, c): in how many toxic and clean texts each feature is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(Restorer(model.value)), [], 0
        for batch in batches:
            labels = batch.column("y").to_numpy(zero_copy_only=False)
            for read in reader.read(batch.column("text")):
                toxic = labels[read.start : read.start + read.texts] == 1
                text, word, at = read.distinct()
                keys, of = np.unique(np.column_stack([read.word[at], read.beginnings[at]]).ravel(), return_inverse=True)
                each = of.reshape(len(at), 1 + len(BEGINNINGS))
                pair = np.unique((text[:, None] << 32 | each[word]).ravel())
                feature, y = pair & 0xFFFFFFFF, toxic[pair >> 32]
                t, n = np.bincount(feature[y], minlength=len(keys)), np.bincount(feature, minlength=len(keys))
                real = keys != 0  # 0 stands for a beginning that isn't there
                held.append((keys[real], t[real], (n - t)[real]))
                size += int(real.sum())
                if size > HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from _counted(held[0])
                        held, size = [], 0
        if held:
            yield from _counted(_summed(held))

    return rows.select("y", "text").mapInArrow(run, "feature long, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, t, c = (np.concatenate([p[i] for p in parts]) for i in range(3))
    if not len(keys):
        return keys, t, c
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(t[order], first), np.add.reduceat(c[order], first)


def _counted(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys, t, c = part
    for i in range(0, len(keys), 100_000):
        some = slice(i, i + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(t[some]), pa.array(c[some])], ["feature", "t", "c"])


def train(docs: DataFrame, labels: DataFrame, model: Models, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    """Learns from every row of labels given that has a document."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    marks = labels.select(named(doc_id).alias("id"), named(label).cast("int").alias("y")).where("y IN (0, 1) AND id IS NOT NULL")
    n = marks.count()
    rows = join_small(docs.select(named(doc_id).alias("id"), named(text).alias("text")), marks, "id", "inner", n)
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    prior = (toxic + 0.5) / (toxic + clean + 1)
    if not toxic:
        return Scorer(base=math.log(prior / (1 - prior)) if toxic + clean else -1.0)
    # candidates: at least LEAST toxic texts
    both = materialise(_frequencies(rows, shared).where(F.col("t") >= LEAST), "features")
    held = both.count()
    precise = (F.col("t") + 0.5) / (F.col("t") + F.col("c") + 1) >= PRECISION
    counts = {r.feature: (r.t, r.c) for r in _beyond_chance(both.where(precise), toxic, clean, held).collect()}
    discard(both)
    found = _contexts(rows.where("y = 1"), shared, counts)
    counts = {r.feature: (r.n, counts[r.feature][1]) for r in found.collect()}
    counts = {f: (n, c) for f, (n, c) in counts.items() if n >= LEAST and (n + 0.5) / (n + c + 1) >= PRECISION and significant(n, c, toxic, clean, held)}
    weights = {f: math.log((n + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) for f, (n, c) in counts.items()}
    taken = sorted((f & (1 << 64) - 1, w) for f, w in weights.items())
    scorer = Scorer(np.array([f for f, _ in taken], U), np.array([w for _, w in taken], float))
    evidence = _evidence(rows, shared, spark.sparkContext.broadcast(scorer))
    # probabilities without and with evidence, smoothed; the line in log odds goes through both
    cells = defaultdict(int)
    for r in evidence.groupBy("y", "some").agg(F.count(F.lit(1)).alias("n"), F.avg("total").alias("mean")).collect():
        cells[r.y, r.some] = r.n
        if r.some and r.y == 1:
            cells["mean"] = r.mean
    without = (cells[1, False] + 0.5) / (cells[1, False] + cells[0, False] + 1)
    having = (cells[1, True] + 0.5) / (cells[1, True] + cells[0, True] + 1)
    logit = lambda p: math.log(p / (1 - p))
    scorer.base = logit(min(without, 0.45))
    # one feature of the least weight is enough to pass a half where texts with evidence are mostly toxic
    lightest = min(weights.values(), default=1.0)
    if having > 0.5:
        scorer.slope = max(logit(having) - scorer.base, -scorer.base + 0.1) / max(0.1, lightest)
    else:
        scorer.slope = max(0.0, logit(having) - scorer.base) / max(0.1, cells["mean"] or 1.0)
    return scorer


def significant(n: int, c: int, toxic: int, clean: int, tested: int) -> bool:
    """Whether n toxic of n + c texts are beyond chance among ``tested`` features: C(n + c, n) p^n stays under CHANCE / tested."""
    ways = math.lgamma(n + c + 1) - math.lgamma(n + 1) - math.lgamma(c + 1)
    return ways + n * math.log((toxic + 0.5) / (toxic + clean + 1)) < math.log(CHANCE / max(1, tested))


def _beyond_chance(counts: DataFrame, toxic: int, clean: int, tested: int) -> DataFrame:
    """Those (feature, t, c) that are significant."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("t").to_pylist(), batch.column("c").to_pylist(), strict=True)
            yield batch.filter(pa.array([significant(n, c, toxic, clean, tested) for n, c in pairs], pa.bool_()))

    return counts.mapInArrow(run, counts.schema)


def _contexts(rows: DataFrame, model, counts: dict) -> DataFrame:
    """(feature, n): between how many different pairs of neighbours each candidate stands in toxic texts."""
    wanted = rows.sparkSession.sparkContext.broadcast(np.sort(np.array(list(counts), np.int64).view(U)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, keys = Reader(Restorer(model.value)), wanted.value
        for batch in batches:
            for read in reader.read(batch.column("text")):
                if not len(read.word) or not len(keys):
                    continue
                same = read.text[1:] == read.text[:-1]
                before, after = np.zeros(len(read.word), U), np.zeros(len(read.word), U)
                before[1:][same], after[:-1][same] = read.word[:-1][same], read.word[1:][same]
                with np.errstate(over="ignore"):
                    context = bw.mix(before * U(0x9E3779B97F4A7C15) + bw.mix(after + U(1)))
                for column in (read.word, *read.beginnings.T):
                    at = np.minimum(np.searchsorted(keys, column), len(keys) - 1)
                    on = keys[at] == column
                    yield pa.RecordBatch.from_arrays([pa.array(column[on].view(np.int64)), pa.array(context[on].view(np.int64))], ["feature", "context"])

    each = rows.select("text").mapInArrow(run, "feature long, context long")
    return each.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


def _evidence(rows: DataFrame, model, scorer) -> DataFrame:
    """y, total log odds, and whether there are any, of each labelled row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Restorer(model.value))
        for batch in batches:
            totals = np.concatenate([np.zeros(0), *(scorer.value.totals(read) for read in reader.read(batch.column("text")))])
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(totals), pa.array(totals > 0)], ["y", "total", "some"])

    return rows.select("y", "text").mapInArrow(run, "y int, total double, some boolean")


def score(docs: DataFrame, scorer: Scorer, model: Models, text: str = "text", with_restored: bool = False) -> DataFrame:
    """``row`` (all columns of docs), score, and on request the restored text (null where nothing was restored)."""
    spark = docs.sparkSession
    ship(spark)
    shared, own = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(scorer)
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, scorer = Restorer(shared.value), own.value
        reader = Reader(restorer)
        for batch in batches:
            texts = part_of(batch, place)
            totals = np.concatenate([np.zeros(0), *(scorer.totals(read) for read in reader.read(texts))])
            columns = [batch.column("row"), pa.array(scorer.score(totals))]
            if with_restored:
                before = texts.to_pylist()
                after = [restorer.restore(t) if t else t for t in before]
                columns.append(pa.array([None if b == t else t for b, t in zip(before, after, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "score", *["restored"] * with_restored])

    return docs.select(as_row(docs)).mapInArrow(run, row_schema(docs, "score double" + ", restored string" * with_restored))


def character_model(docs: DataFrame, text: str = "text") -> Models:
    """One model of the words of all texts."""
    return fit(count_grams(docs.select(F.lit("*").alias("label"), named(text).alias("text")), "label", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = character_model(docs)
    scorer = train(docs, labels.where(fold("doc_id", 5) != 0), model)
    out = score(docs, scorer, model)
    return out.select("row.doc_id", F.coalesce(fold("row.doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
