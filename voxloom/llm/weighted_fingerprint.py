"""Document fingerprints by consistent weighted sampling.

Terms are the words of a text (lower-cased, between white space), weighted by how often they occur. For sample
s and term x a hash draws r and c from Gamma(2, 1) and b from (0, 1). With weight w,

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1),

and the sample is the pair (x, t) with the least a. Two texts have equal samples with a probability equal to
their generalised Jaccard similarity, sum of least weights over sum of greatest; the share of equal samples
estimates it. Gamma draws come from a table of ``GRID`` quantiles. a and a 32-bit code of (x, t) share one
long, so a sample is a plain minimum that the hash aggregate keeps in place.

Built-in functions only. Texts are shuffled once, by row; words are counted and sampled in the partition where
their text is.

The edited text of a document replaces its last floor(n / 4) characters by as many from the front of the next
document's text. The next document is found without bringing rows together: ids are range-partitioned, each
takes the next in its partition, and the last of each the first of the next partition.

Cases: null text is empty; texts without words share one fingerprint of their own and are like each other
(1), unlike others (0); rows with equal id and text count as one document in the order and come out as often
as they came in; equal ids with different texts follow each other by a hash of the text; null ids come first;
after the last document follows the first, so a single one follows itself; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, materialise, named, shuffle_partitions, table

SAMPLES = 32
#: Samples that one pass over a text's terms draws.
AT_ONCE = 4
#: Quantiles in the table of gamma draws; a power of two.
GRID = 2048
NO_ID = -(1 << 63)
#: Code of a sample of a text without words.
EMPTY = -1


@lru_cache(1)
def gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of GRID equal steps, by bisection of 1 - (1 + x) exp(-x)."""
    p = (np.arange(GRID) + 0.5) / GRID
    low, high = np.zeros(GRID), np.full(GRID, 50.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def _constant(values: np.ndarray) -> Column:
    """An array that the optimizer folds to one literal."""
    return F.split(F.lit(",".join(f"{v:.7g}" for v in values.tolist())), ",").cast("array<double>")


def _bits(h: Column, shift: int, size: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(size - 1))


def _sampled(log_weight: Column, s: int) -> Column:
    """A term's sample s as a long whose minimum is the text's; null where the weight is null."""
    r, log_c, b = F.col(f"r{s}"), F.col(f"c{s}"), F.col(f"b{s}")
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b + F.lit(1.0))
    code = F.col("high").bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(((log_a + F.lit(64.0)) * F.lit(float(1 << 24))).cast("long"), 32).bitwiseOR(code)


def _draws(s: int, gamma: Column, log_gamma: Column) -> list[Column]:
    """r and c from Gamma(2, 1), the latter as its logarithm, and b, of term and sample, from one hash."""
    h = F.xxhash64("term", "set", F.lit(s))
    r = F.get(gamma, _bits(h, 0, GRID).cast("int"))
    c = F.get(log_gamma, _bits(h, 16, GRID).cast("int"))
    return [r.alias(f"r{s}"), c.alias(f"c{s}"), ((_bits(h, 32, 1 << 24) + F.lit(0.5)) * F.lit(2.0**-24)).alias(f"b{s}")]


def signatures(texts: DataFrame, keys: list[str], head: str, tails: list[str]) -> DataFrame:
    """keys and ``sig_<tail>``: array<int> of SAMPLES codes for each of the texts head + tail.

    The head must end between words. texts should be partitioned by (some of) keys already. A term has its draws
    made once for all texts in which it stands. Keys without any word give no row.
    """
    parts = F.array(*(F.struct(F.lit(i).alias("of"), F.col(c).alias("part")) for i, c in enumerate([head, *tails])))
    each = texts.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.of", F.explode(F.split(F.lower("p.part"), r"\s+")).alias("word")).where("word <> ''")
    weight = lambda i: F.count(F.when((F.col("of") == 0) | (F.col("of") == i + 1), True)).alias(f"w{i}")
    terms = each.select(*keys, "of", F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(*(weight(i) for i in range(len(tails))))
    logs = [F.when(F.col(f"w{i}") > 1, F.log(F.col(f"w{i}").cast("double"))).when(F.col(f"w{i}") == 1, F.lit(0.0)).alias(f"lw{i}") for i in range(len(tails))]
    gamma, log_gamma = _constant(gamma_quantiles()), _constant(np.log(gamma_quantiles()))
    # samples are drawn a few at a time: code for all at once is too long for the JVM's compiler
    sets = terms.select(*keys, "term", F.shiftrightunsigned("term", 32).alias("high"), *logs, F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // AT_ONCE - 1))).alias("set"))
    drawn = sets.select(*keys, "set", "high", *(f"lw{i}" for i in range(len(tails))), *(d for s in range(AT_ONCE) for d in _draws(s, gamma, log_gamma)))
    least = [F.min(_sampled(F.col(f"lw{i}"), s)).alias(f"s{i}_{s}") for i in range(len(tails)) for s in range(AT_ONCE)]
    short = lambda i, s: F.coalesce((F.col(f"s{i}_{s}").bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int"), F.lit(EMPTY))
    few = drawn.groupBy(*keys, "set").agg(*least).select(*keys, "set", *(F.array(*(short(i, s) for s in range(AT_ONCE))).alias(f"a{i}") for i in range(len(tails))))
    in_order = lambda i: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("set", f"a{i}"))), lambda x: x[f"a{i}"]))
    return few.groupBy(*keys).agg(*(in_order(i).alias(f"sig_{c}") for i, c in enumerate(tails)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return equal.cast("double") / SAMPLES


def fingerprint(sig: Column) -> Column:
    """Hexadecimal digits of a signature."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def successors(ids: DataFrame, partitions: int) -> DataFrame:
    """(k, h, n) of distinct rows, with nk, nh of the next in ascending order; the first follows the last. Written to the shared folder."""
    placed = ids.repartitionByRange(partitions, "k", "h").withColumn("part", F.spark_partition_id())
    placed = materialise(placed, "ordered-ids")
    firsts = placed.groupBy("part").agg(F.min(F.struct("k", "h")).alias("first"))
    order = W.orderBy("part")  # one row a partition
    around = firsts.select("part", F.coalesce(F.lead("first").over(order), F.min("first").over(W.partitionBy())).alias("after"))
    own = W.partitionBy("part").orderBy("k", "h")
    led = placed.withColumn("next", F.lead(F.struct("k", "h")).over(own)).join(F.broadcast(around), "part")
    after = F.coalesce("next", "after")
    out = materialise(led.select("k", "h", "n", after["k"].alias("nk"), after["h"].alias("nh")), "successors")
    discard(placed)
    return out


def compare_with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(named(doc_id).alias("doc_id"), F.coalesce(named(text), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    rows = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64("text").alias("h"), "text")
    ids = materialise(rows.groupBy("k", "h").agg(F.max(F.char_length("text").cast("long")).alias("n"), F.count(F.lit(1)).alias("copies")), "ids")
    repeated = bool(ids.where("copies > 1").head(1))
    order = successors(ids.select("k", "h", "n"), parts)
    if not repeated:
        discard(ids)

    # both uses of it read the same columns, so that texts are shuffled once
    held = rows.repartition(parts, "k", "h")
    if repeated:
        held = held.dropDuplicates(["k", "h"])
    need = order.select(F.col("nk").alias("k"), F.col("nh").alias("h"), F.col("k").alias("pk"), F.col("h").alias("ph"), F.floor(F.col("n") / 4).cast("int").alias("need"))
    front = held.join(need.hint("merge"), ["k", "h"]).select(F.col("pk").alias("k"), F.col("ph").alias("h"), F.expr("substring(text, 1, need)").alias("front"))
    both = held.join(front.hint("merge"), ["k", "h"])
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"), F.col("front"))
    both = both.select("k", "h", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    # both texts begin alike; up to the last white space of that part their words are the same
    kept = F.regexp_replace(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"), r"\S*$", "")
    cut = both.select("k", "h", "text", "edited", kept.alias("head"))
    rest = lambda c: F.expr(f"substring({c}, char_length(head) + 1)").alias(f"{c}_tail")
    pair = signatures(cut.select("k", "h", "head", rest("text"), rest("edited")), ["k", "h"], "head", ["text_tail", "edited_tail"])
    none = F.array_repeat(F.lit(EMPTY), SAMPLES)
    pair = pair.select("k", "h", F.col("sig_text_tail").alias("sig"), F.col("sig_edited_tail").alias("edited_sig"))
    facts = both.select("k", "h", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    made = facts.join(pair.hint("merge"), ["k", "h"], "left").withColumns({c: F.coalesce(c, none) for c in ("sig", "edited_sig")})
    made = materialise(made, "fingerprints")

    nexts = order.select("k", "h", "nk", "nh").join(made.select(F.col("k").alias("nk"), F.col("h").alias("nh"), F.col("sig").alias("next_sig")), ["nk", "nh"]).select("k", "h", "next_sig")
    out = made.join(nexts, ["k", "h"])
    if repeated:
        out = out.join(ids.select("k", "h", "copies"), ["k", "h"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")
    return out.select(
        F.nullif("k", F.lit(NO_ID)).cast(id_type).alias("doc_id"), "n_chars", "edited_sha256", fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )


def op4_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
