"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A text's set holds the hashes of its distinct k-word shingles. Two sets of sizes x and y reach the similarity t
only if they differ in at most (1 - t) / (1 + t) * (x + y) tokens. Sizes are cut into bands; in each band the
hashed universe is split into more segments than tokens may differ, so that similar sets agree in whole
segments, and every set is indexed by its segments.

Allocation by cost. An empty segment has the longest list of all and is allocated 0: it is no key. The others
are allocated 1: their content is a key. A band has a few segments more than needed, so that a set keeps
enough segments that aren't empty: of more than the H tokens in which any partner can differ, at least one
agrees with the partner's. A set that falls short is indexed once more, in a list of its own kind: whole
segments, empty ones included, and for as many segments as it lacks all neighbourhoods of one deletion
(allocated 2). A pair of which at most one falls short meets in the first index, others in the second.

Spare keys. A set with F full segments in a band, of which any partner can differ in at most H, agrees with each partner
in F - H of them at least. So it gives up the F - H - 1 keys that most sets share (ties: the least key). The order is the
same for all sets, so what either of two linked sets gives up of their common keys are the first ones of these, fewer
than they have. Long texts that only have a common line in one segment lose such keys; each key is counted again then.

Only what connects is looked for: a pair whose sets are known to be in one component needs no check. Pairs are proposed
from keys and dropped, before any text is fetched, where their parities differ too much: the parity of the number of
tokens in each of ``PARITY`` slots differs between two sets in at most as many slots as the sets differ in tokens.

Keys with up to ``FEW`` sets propose all their pairs. Keys with more have a pivot, the set that shares most such
keys; all others are paired with it. Keys with up to ``CLOSE`` sets then propose, of each set, the nearest one by
parities in another component (within ``CHUNK`` sets), and at last, when these links are known, all pairs of sets in different components
whose parities allow a link. A cluster of near copies is one component by then. Sets that share many keys would come out
under each of them: every row holds the ``LEAST`` least keys of its set, and a pair is left to a lesser key that both hold.

Keys with more than ``CLOSE`` sets are hot. All their sets are compared with the pivot, and what is left is found
among differences. For sets x and y with differences dx and dy from their pivot, the distance of x and y is that of
dx and dy. So a linked pair of which one isn't linked to the pivot shares a token among the first few of its
differences, in any fixed order; pairs of which both are in the pivot's component don't matter. The order puts tokens first that the pivot lacks, rare ones before common ones,
then those that only the pivot has, common ones before rare ones, as most sets lack what is rare; a count sketch of
``SLOTS`` slots over the sets at hand tells how common a token is. Such tokens are keys of the next level, of
``LEVELS`` at most, as long as each halves the rows of hot keys; the last one's hot keys are listed like others, by a join. A star of n near copies thus costs n
comparisons, not n².

Every pair is verified on its two whole texts. Tokens are 64-bit hashes of word sequences; two different
shingles share one with probability 2^-64.

Cases: null texts and texts without words have empty sets and are linked with nothing (component: their own
id); fewer than k words are one shingle; equal sets are one class, whatever the texts; repeated rows and rows
with equal ids come out as often as they came in, each row with the component of its own text; rows with a
null id get the component of their class (null if all ids in it are null); an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import discard, join_small, let_go, materialise, named, ship, shuffle_partitions, table
from .components import connected_components

U = np.uint64
#: Upper end of a size band over its lower end.
BAND = 1.5
#: Bits that hold a band's number.
BAND_BITS = 7
#: Levels of pivots for hot keys.
LEVELS = 6
#: Sets of one key up to which parities are compared with each other.
CLOSE = 4096
#: Sets among which the nearest is looked for.
CHUNK = 1024
#: Least keys of a set that its rows hold.
LEAST = 16
#: Slots of a set's parities; a multiple of 64.
PARITY = 512
#: Stands for a null id where texts are fetched.
NO_ID = -(1 << 63)
#: Sets of one key up to which all pairs are proposed.
FEW = 8
#: Slots of the token counts that are broadcast.
SLOTS = 1 << 18


class Scheme:
    """Bands and segments for a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * BAND)))
        self._parts: dict[int, tuple[int, int]] = {}

    def linked(self, common: int, x: int, y: int) -> bool:
        """Exactly: common / union >= num / den."""
        return self.den * common >= self.num * (x + y - common)

    def differ(self, x: int, y: int) -> int:
        """Most tokens in which linked sets of these sizes can differ."""
        return (self.den - self.num) * (x + y) // (self.den + self.num)

    def reach(self, x: int) -> int:
        """Most tokens in which a linked partner of any size can differ from a set of size x."""
        return self.differ(x, x * self.den // self.num)

    def band(self, x: int) -> int:
        return int(np.searchsorted(self.lows, x, "right")) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """(H, segments) of a band: H for the largest pair in it; segments so that few sets fall short."""
        if band not in self._parts:
            most = self.lows[band + 1] - 1
            h = self.differ(most, most)
            sizes = [max(1, self.lows[band] * self.num // self.den), self.lows[band], most]

            def enough(m: int, x: int) -> bool:
                """Expected full segments of a set of size x, less four deviations, are more than its partners can differ."""
                empty = np.exp(-x / m)
                deviation = np.sqrt(m * empty * max(0.0, 1 - (1 + x / m) * empty))
                return m * (1 - empty) - 4 * deviation > min(h, self.reach(x))

            fit = (m for m in range(h + 1, 2 * h + 4) if all(enough(m, x) for x in sizes))
            self._parts[band] = (h, next(fit, h + 1 + h // 8))
        return self._parts[band]

    def bands(self, x: int) -> list[int]:
        """Bands in which a set of size x meets partners at least as large: its own and all that it reaches."""
        return list(range(self.band(x), self.band(x * self.den // self.num) + 1))


def signatures(tokens: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Keys of one set."""
    return np.concatenate([keys for keys, _ in signature_lists(tokens, scheme)])


def signature_lists(tokens: np.ndarray, scheme: Scheme) -> list[tuple[np.ndarray, int]]:
    """Keys of one set by list, each with the list's name: spare keys << BAND_BITS, plus the band."""
    out = []
    with np.errstate(over="ignore"):
        for band in scheme.bands(len(tokens)):
            h, m = scheme.parts(band)
            salt = U((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            spread = bw.mix(tokens ^ salt)
            segment = ((spread >> U(32)) * U(m)) >> U(32)
            order = np.argsort(segment.astype(np.uint32), kind="stable")
            segment, content = segment[order], bw.mix(spread[order] + salt)
            start = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sums = np.add.reduceat(content, start)
            full = segment[start]
            most = min(h, scheme.reach(len(tokens)))
            out.append((bw.mix(sums + bw.mix(full + salt)), max(0, len(full) - most - 1) << BAND_BITS | band))
            if len(full) <= most:
                out.append((_short(content, segment, full, sums, most, m, salt), band))
    return out


def _short(content: np.ndarray, segment: np.ndarray, full: np.ndarray, sums: np.ndarray, h: int, m: int, salt: np.uint64) -> np.ndarray:
    """Second index of a set with at most h full segments, h being the most in which a partner can differ.

    Designated segments are 0 .. r-1, r the least number with (full segments not among them) + 2 r > h.
    """
    is_full = np.zeros(m, bool)
    is_full[full.astype(np.int64)] = True
    rest = len(full) - np.concatenate([[0], np.cumsum(is_full)])
    r = int(np.argmax(rest + 2 * np.arange(m + 1) > h))  # r = m always does, as 2 m > h
    total = np.zeros(m, U)
    total[full.astype(np.int64)] = sums
    names = np.arange(m, dtype=U)
    kind = bw.mix(salt + U(0xD1B54A32D192ED03))
    whole = bw.mix(total[:r] + bw.mix(names[:r] + kind))
    mine = segment < U(r)
    at = segment[mine].astype(np.int64)
    return np.concatenate([whole, bw.mix(total[at] - content[mine] + bw.mix(names[at] + kind))])


def node_of(tokens: np.ndarray) -> int:
    """An order-free hash of a set."""
    with np.errstate(over="ignore"):
        return int(bw.mix(np.array([bw.mix(tokens + U(1)).sum(dtype=U)], U) + U(len(tokens))).view(np.int64)[0])


def sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted shingle hashes of each text; none for null or wordless ones."""
    for row, end, block in bw.blocks(texts, bw.spaces_table()):
        first = block.first.tolist()
        for d in range(end - row):
            yield bw.shingle_set(block.hashes[first[d] : first[d + 1]], k)


def shingle_sizes(rows: DataFrame, k: int) -> DataFrame:
    """id, n_shingles, node (a hash of the set; null for an empty one) and the set's parities, of each row of (id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            sizes, nodes, odd = [], [], []
            for s in sets_of(batch.column("text"), k):
                sizes.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                odd.append(parities(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(odd, pa.list_(pa.int64()))], ["id", "n_shingles", "node", "parity"])

    return rows.mapInArrow(run, "id long, n_shingles long, node long, parity array<long>")


def index(rows: DataFrame, k: int, scheme: Scheme) -> DataFrame:
    """(key, node, list) of each set, once for each set that a task has seen. list: see signature_lists."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: set[int] = set()
        for batch in batches:
            lists, nodes, size = [], [], 0
            for s in sets_of(batch.column("text"), k):
                if not len(s):
                    continue
                node = node_of(s)
                if node in seen:
                    continue
                seen.add(node)
                if len(seen) > 250_000:  # repeated keys do no harm
                    seen.clear()
                for some in signature_lists(s, scheme):
                    lists.append(some)
                    nodes.append(node)
                    size += len(some[0])
                if size > 200_000:
                    yield _keyed(lists, nodes)
                    lists, nodes, size = [], [], 0
            if lists:
                yield _keyed(lists, nodes)

    return rows.mapInArrow(run, "key long, node long, list long")


def _keyed(lists: list[tuple[np.ndarray, int]], nodes: list[int]) -> pa.RecordBatch:
    sizes = [len(keys) for keys, _ in lists]
    columns = [np.concatenate([keys for keys, _ in lists]).view(np.int64), np.repeat(np.array(nodes, np.int64), sizes), np.repeat(np.array([name for _, name in lists], np.int64), sizes)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "list"])


def several(keyed: DataFrame) -> DataFrame:
    """keyed, once for each (key, node), and n, of keys that n > 1 sets share."""
    own = keyed.repartition(shuffle_partitions(keyed.sparkSession), "key").dropDuplicates(["key", "node"])
    return own.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key"))).where("n > 1")


def needed(shared: DataFrame) -> DataFrame:
    """(key, node, n) without the spare keys of each (node, list), those that most sets share. Keys of one set are left out of ``shared``, as they come last."""
    rank = F.row_number().over(W.partitionBy("node", "list").orderBy(F.desc("n"), "key"))
    return several(shared.withColumn("rank", rank).where(F.col("rank") > F.shiftright("list", BAND_BITS)).select("key", "node"))


def few_pairs(shared: DataFrame) -> DataFrame:
    """(a, b), a < b, of all keys with at most FEW sets."""
    some = shared.where(F.col("n") <= FEW).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all"))  # at most FEW each
    later = lambda x, i: F.transform(F.slice("all", i + 2, FEW), lambda y: F.struct(x.alias("a"), y.alias("b")))
    return some.select(F.inline(F.flatten(F.transform("all", later))))


def star_pairs(hot: DataFrame) -> DataFrame:
    """(pivot, node) of hot keys: the pivot is the member whose hot keys have most members in all."""
    weight = hot.groupBy("node").agg(F.sum("n").alias("w"))
    ranked = hot.select("key", "node").join(weight, "node")
    pivot = ranked.groupBy("key").agg(F.max(F.struct("w", "node"))["node"].alias("pivot"))
    return ranked.join(pivot, "key").where("node <> pivot").select("pivot", "node").distinct()


def _may(scheme: Scheme, x: str, y: str) -> Column:
    """Whether the parities of two sets allow a link."""
    apart = F.aggregate(F.zip_with(f"{x}.parity", f"{y}.parity", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, b: n + b)
    return apart <= F.expr(f"({scheme.den - scheme.num} * ({x}.size + {y}.size)) div {scheme.den + scheme.num}")


def possible(pairs: DataFrame, info: DataFrame, scheme: Scheme) -> DataFrame:
    """Those pairs (a, b) whose parities allow a link. info: (node, size, parity)."""
    x, y = info.alias("x"), info.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_may(scheme, "x", "y")).select("a", "b")


def close_pairs(hot: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b), a < b, of sets of each key that are in different components and whose parities allow a link."""
    x, y = hot.alias("x"), hot.alias("y")
    found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")) & _may(scheme, "x", "y"))
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def least_keys(rows: DataFrame) -> DataFrame:
    """(node, least): the LEAST least keys of each set, filled up with the largest long."""
    rank = F.row_number().over(W.partitionBy("node").orderBy("key"))
    some = rows.select("node", "key").withColumn("rank", rank).where(F.col("rank") <= LEAST)
    filled = F.concat(F.collect_list("key"), F.array_repeat(F.lit((1 << 63) - 1), LEAST))  # at most LEAST each
    return some.groupBy("node").agg(F.slice(filled, 1, LEAST).alias("least"))


def _met(x: np.ndarray, y: np.ndarray, key: int) -> np.ndarray:
    """Whether the least keys of two sets, row by row, have one under ``key`` in common."""
    out = np.zeros(len(x), bool)
    for i in range(x.shape[1]):
        out |= (x[:, i] < key) & (y == x[:, i, None]).any(1)
    return out


def near_pairs(rows: DataFrame, scheme: Scheme, nearest: bool) -> DataFrame:
    """(a, b), a < b, of sets of each key (of at most CLOSE) that are in different components and whose parities
    allow a link: for each set the nearest one, or all. rows: (key, node, size, parity, comp), each (key, node) once.

    Of all, a key leaves out the pairs that are known to meet under a lesser key; the least key of a pair never does.
    """

    def pairs(key: int, node: np.ndarray, size: np.ndarray, comp: np.ndarray, odd: np.ndarray, least: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(node), 64):
            part = slice(i, i + 64)
            apart = np.zeros((len(node[part]), len(node)), np.int32)
            for p in odd.T:
                apart += np.bitwise_count(p[part, None] ^ p[None, :])
            may = (apart <= (scheme.den - scheme.num) * (size[part, None] + size[None, :]) // (scheme.den + scheme.num)) & (comp[part, None] != comp[None, :])
            if nearest:
                best = np.where(may, apart, PARITY + 1).argmin(1)
                at = np.flatnonzero(may[np.arange(len(best)), best])
                x, y = at + i, best[at]
            else:
                x, y = np.nonzero(may)
                x = x + i
                x, y = x[x < y], y[x < y]
                if len(x):
                    new = np.concatenate([~_met(least[x[j : j + 8192]], least[y[j : j + 8192]], key) for j in range(0, len(x), 8192)])
                    x, y = x[new], y[new]
            yield np.minimum(node[x], node[y]), np.maximum(node[x], node[y])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            if batch is None:
                now, cut = held, len(held[0]) if held else 0
            else:
                odd = pc.list_flatten(batch.column("parity")).to_numpy().view(U).reshape(-1, PARITY // 64)
                now = [*(batch.column(c).to_numpy() for c in ("key", "node", "size", "comp")), odd]
                if not nearest:
                    now.append(pc.list_flatten(batch.column("least")).to_numpy().reshape(-1, LEAST))
                now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
                cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last key may go on
                held = [x[cut:] for x in now]
            if not cut:
                continue
            key, node, size, comp, odd, *least = (x[:cut] for x in now)
            bounds = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), cut)
            found = [np.zeros((2, 0), np.int64)]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if (comp[a:b] != comp[a]).any():
                    found += pairs(key[a], node[a:b], size[a:b], comp[a:b], odd[a:b], *(x[a:b] for x in least))
            x, y = np.unique(np.concatenate([np.vstack(f) for f in found], 1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    wanted = ["key", "node", "size", "parity", "comp"]
    if not nearest:
        rows, wanted = rows.join(least_keys(rows), "node"), [*wanted, "least"]
    dealt = rows.select(*wanted).repartition(shuffle_partitions(rows.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def parities(tokens: np.ndarray) -> np.ndarray:
    """Bits of whether an odd number of tokens is in each slot."""
    odd = np.bincount((tokens & U(PARITY - 1)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


class _Sets:
    """Shingle sets by node, the latest ones kept."""

    def __init__(self, k: int):
        self.k, self.kept, self.size = k, OrderedDict(), 0

    def get(self, node: int, text: str) -> np.ndarray:
        if node in self.kept:
            self.kept.move_to_end(node)
            return self.kept[node]
        s = next(sets_of(pa.array([text], pa.string()), self.k))
        self.kept[node] = s
        self.size += len(s)
        while self.size > 4_000_000 and len(self.kept) > 1:
            self.size -= len(self.kept.popitem(last=False)[1])
        return s


def token_ranks(texts: DataFrame, k: int) -> np.ndarray:
    """How common the tokens of each slot are over all sets: 0 up to twice the mean, then one more for each doubling."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for s in sets_of(batch.column("text"), k):
                counts += np.bincount(_slot(s), minlength=SLOTS) if len(s) > SLOTS // 8 else 0
                if len(s) <= SLOTS // 8:
                    np.add.at(counts, _slot(s), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])], ["slot", "n"])

    summed = texts.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.int64)
    counts[summed["slot"].to_numpy()] = summed["n"].to_numpy()
    return np.clip(np.log2(np.maximum(counts, 1) / max(1.0, counts.mean())), 0, 60).astype(np.int64)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def verify(pairs: DataFrame, texts: DataFrame, k: int, scheme: Scheme, ranks=None) -> DataFrame:
    """(a, b, linked, diff) of pairs (a, b, star): diff for stars, the first differences of b from a, as far as they can matter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        sets = _Sets(k)
        rank = None if ranks is None else ranks.value
        for batch in batches:
            a, b, ta, tb, star = (batch.column(c) for c in ("a", "b", "ta", "tb", "star"))
            linked, diff = [], []
            for i in range(batch.num_rows):
                x, y = sets.get(a[i].as_py(), ta[i].as_py()), sets.get(b[i].as_py(), tb[i].as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(scheme.linked(common, len(x), len(y)))
                if not star[i].as_py():
                    diff.append(None)
                    continue
                own, gone = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                other = np.concatenate([own, gone])
                rarity = rank[_slot(other)]
                rarity[len(own) :] = 127 - rarity[len(own) :]
                order = np.argsort(rarity, kind="stable")
                diff.append(other[order[: scheme.reach(len(y)) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_()), pa.array(diff, pa.list_(pa.int64()))], ["a", "b", "linked", "diff"])

    n = pairs.count()
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = join_small(texts, need, "node", "left_semi", 2 * n)
    ta = some.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = some.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb", "star")
    return joined.mapInArrow(run, "a long, b long, linked boolean, diff array<long>")


def next_keys(stars: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, node) of the next level: tokens of first differences, under their pivot, where a set that isn't in the pivot's component has one too."""
    of = lambda name: comps.select(F.col("node").alias(name), F.col("comp").alias(f"of_{name}"))
    placed = stars.select("a", "b", "diff").join(of("a"), "a", "left").join(of("b"), "b", "left")
    near = F.coalesce("of_a", "a") == F.coalesce("of_b", "b")
    each = placed.select(F.col("a").alias("pivot"), F.col("b").alias("node"), near.alias("near"), F.explode("diff").alias("token"))
    alone = each.where("NOT near").groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("alone")).drop("alone")
    return each.join(alone, ["pivot", "token"]).select(F.xxhash64("pivot", "token").alias("key"), "node")


class Finder:
    """Links found so far, and the pairs that were verified."""

    def __init__(self, docs: DataFrame, sizes: DataFrame, k: int, scheme: Scheme):
        self.spark, self.docs, self.k, self.scheme = docs.sparkSession, docs, k, scheme
        # one row for each set: the smallest of its ids that isn't null, and the texts under that id that have the set
        one = sizes.where("node IS NOT NULL").groupBy("node").agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("id"), F.first("n_shingles").alias("size"), F.first("parity").alias("parity"))
        self.one, self.texts, self.ranks, self.found, self.scratch = one, None, None, [], []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """A table that goes with the finder."""
        out = materialise(df, name, free=True)
        self.scratch.append(out)
        return out

    def start(self, shared: DataFrame) -> None:
        """Fetches the sets that share a key; later levels have no others."""
        self.info = self.keep(self.one.join(shared.select("node").distinct(), "node"), "ngram-nodes")
        need = self.info.select("node", "id")
        docs = self.docs.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
        self.texts = self.keep(_own(join_small(docs, need, "id", "inner", need.count()).select("node", "text"), self.k), "ngram-texts")

    def check(self, pairs: DataFrame, star: bool = False) -> DataFrame:
        """Verifies pairs (a, b) that weren't yet; stars get differences."""
        pairs = pairs.select("a", "b").distinct()
        if self.found and not star:  # as stars, they need their differences
            pairs = pairs.join(reduce(DataFrame.union, [f.select("a", "b") for f in self.found]), ["a", "b"], "left_anti")
        pairs = self.keep(pairs.withColumn("star", F.lit(star)), "ngram-pairs")
        if star and self.ranks is None:
            self.ranks = self.spark.sparkContext.broadcast(token_ranks(self.texts, self.k))
        out = self.keep(verify(pairs, self.texts, self.k, self.scheme, self.ranks if star else None), "ngram-links")
        self.found.append(out)
        return out

    def links(self) -> DataFrame:
        return reduce(DataFrame.union, [f.where("linked").select("a", "b") for f in self.found])

    def labels(self) -> DataFrame:
        """(node, comp): the smallest node that two links reach. Sets with one label are in one component; that is
        enough for pivots and those linked to them, and costs no rounds."""
        links = self.links()
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        least = both.groupBy("node").agg(F.min("other").alias("m")).select(F.col("node").alias("other"), F.least("node", "m").alias("m"))
        return both.join(least, "other").groupBy("node").agg(F.min("m").alias("comp"))

    def components(self) -> DataFrame:
        """(node, comp) by all links so far."""
        out = connected_components(self.links().select(F.col("a").alias("src"), F.col("b").alias("dst")))
        self.scratch.append(out)
        return out.withColumnRenamed("component", "comp")

    def placed(self, rows: DataFrame, comps: DataFrame) -> DataFrame:
        """rows (key, node, n) with size, parity and component of the node. Keys in one component propose nothing."""
        nodes = self.info.select("node", "size", "parity").join(comps, "node", "left").select("node", "size", "parity", F.coalesce("comp", "node").alias("comp"))
        return rows.select("key", "node", "n").join(nodes, "node")

    def close(self) -> None:
        for df in self.scratch:
            discard(df)
        if self.ranks is not None:
            self.ranks.destroy()


def find_links(docs: DataFrame, sizes: DataFrame, k: int, scheme: Scheme) -> DataFrame:
    """(a, b) nodes of links that connect all that is connected. docs: (id, text); sizes: its shingle_sizes."""
    finder = Finder(docs, sizes, k, scheme)
    shared = finder.keep(needed(several(index(docs.select("text"), k, scheme))), "ngram-keys")
    finder.start(shared)
    before = None
    for level in range(LEVELS + 1):
        hot = shared.where(F.col("n") > CLOSE)
        stars = star_pairs(shared.where((F.col("n") > FEW) & (F.col("n") <= CLOSE))).select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
        finder.check(possible(few_pairs(shared).union(stars).distinct(), finder.info, scheme))
        heat = hot.count()
        more = level < LEVELS and heat > 0 and (before is None or 2 * heat <= before)
        before = heat
        if heat:
            differ = finder.check(star_pairs(hot).select(F.col("pivot").alias("a"), F.col("node").alias("b")), star=True)
        # the nearest in other components first (of large keys, in chunks), then whatever is left between components
        large = shared.where(F.col("n") > FEW)
        if some := bool(large.head(1)):
            chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / CHUNK))
            rows = finder.placed(large.withColumn("key", F.when(F.col("n") > CHUNK, F.xxhash64("key", chunk)).otherwise(F.col("key"))), finder.labels())
            finder.check(near_pairs(rows, scheme, nearest=True))
        if some or more:
            comps = finder.components()
        if some:
            left = near_pairs(finder.placed(large.where(F.col("n") <= CLOSE), comps), scheme, nearest=False)
            if heat and not more:
                left = left.union(close_pairs(finder.placed(hot, comps), scheme))
            finder.check(left)
        if not more:
            break
        shared = finder.keep(several(next_keys(differ, comps)), "ngram-keys")
    out = materialise(finder.links().distinct(), "ngram-found", free=True)
    finder.close()
    return out


def _own(texts: DataFrame, k: int) -> DataFrame:
    """One text of each node; texts that only share an id with the node's go."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            yield batch.filter(pa.array([bool(len(s)) and node_of(s) == n for n, s in zip(nodes, sets_of(batch.column("text"), k), strict=True)], pa.bool_()))

    return texts.mapInArrow(run, "node long, text string").dropDuplicates(["node"])


def components(docs: DataFrame, k: int, num: int, den: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id that links of similarity num / den reach."""
    spark = docs.sparkSession
    ship(spark)
    scheme = Scheme(num, den)
    rows = docs.select(named(doc_id).cast("long").alias("id"), named(text).alias("text"))
    sizes = materialise(shingle_sizes(rows, k), "ngram-sizes")
    links = find_links(rows, sizes, k, scheme)
    groups = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    smallest = sizes.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"))
    grouped = smallest.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    lowest = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    grouped = materialise(grouped.join(lowest, "group").select("node", "component_id"), "ngram-components", free=True)
    discard(links)
    discard(groups)
    out = sizes.select("id", "n_shingles", "node").join(grouped, "node", "left")
    out = out.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    out._parts = [sizes, grouped]  # for a caller that discards them
    return out


def keep_one(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of its component; rows with a null id or an empty set stay."""
    found = components(docs, k, num, den, doc_id=doc_id, text=text)
    gone = materialise(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone id")).distinct(), "ngram-gone", free=True)
    for part in found._parts:
        discard(part)
    n = gone.count()
    hinted = F.broadcast(gone) if n <= 1_000_000 else gone.hint("merge")
    return docs.join(hinted, named(doc_id).cast("long") == hinted["gone id"], "left_anti")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9."""
    return components(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 9, 10)


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = doc_id GROUP BY doc_id
"""
