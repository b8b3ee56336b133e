"""Hierarchical weighted hash tree: a key descends region, rack and shard by weighted hash draws.

At every level each child draws -ln(u) / weight from a hash of key and child, and the smallest draw wins. A
child is chosen with probability proportional to its weight, and a changed weight only moves keys into or out
of that child: nothing moves between its siblings, so movement stays in subtrees whose weights change. The
weight of an inner node is the sum of its shards'.

Law ``key``: the id and the topology decide alone. ``grown`` opens a region with one shard, the only place to
which rows then move; a shard added to an old rack would also draw keys into that rack's region, and these
settle on any of its shards.

Slots number the rows of a shard from 0 without gaps: rows fall into ``BUCKETS`` hash buckets a shard, are
counted by bucket, and get their rank in the bucket plus the count of the buckets before. No task gets a
whole shard. Built-in functions only.

Cases: null ids share one place; null text has 0 bytes and no checksum, empty text 0 bytes and checksum 0;
repeated ids stay together in a shard, each row with a slot of its own; an empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, table

#: region -> rack -> shard number -> weight
Topology = dict[str, dict[str, dict[int, float]]]
BUCKETS = 1024


def even_topology(regions: int = 2, racks: int = 3, shards: int = 4) -> Topology:
    """Equal weights, shards numbered in order."""
    return {f"region{r}": {f"rack{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)} for k in range(racks)} for r in range(regions)}


def grown(topology: Topology, weight: float = 1.0) -> Topology:
    """With one more shard, in a region of its own."""
    n = 1 + max(s for racks in topology.values() for shards in racks.values() for s in shards)
    return topology | {f"region-of-shard{n}": {"rack0": {n: weight}}}


def _total(node: dict | float) -> float:
    return sum(map(_total, node.values())) if isinstance(node, dict) else float(node)


def _pick(key: Column, path: str, node: dict) -> Column:
    """The shard under ``node``, by a draw among its children and then below the winner."""
    children = {name: child for name, child in node.items() if _total(child) > 0}
    names = sorted(children, key=str)
    below = {name: _pick(key, f"{path}/{name}", children[name]) if isinstance(children[name], dict) else F.lit(int(name)) for name in names}
    if len(names) == 1:
        return below[names[0]]
    draws = []
    for i, name in enumerate(names):
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{path}/{name}")), 11).cast("double") + 0.5) * F.lit(2.0**-53)
        draws.append(F.struct((-F.log(uniform) / F.lit(_total(children[name]))).alias("draw"), F.lit(i).alias("child")))
    winner = F.array_min(F.array(*draws))["child"]
    if all(not isinstance(c, dict) for c in children.values()):
        return F.element_at(F.array(*(below[n] for n in names)), winner + 1)
    out = below[names[-1]]
    for i, name in reversed(list(enumerate(names[:-1]))):
        out = F.when(winner == i, below[name]).otherwise(out)
    return out


def place(key: Column, topology: Topology) -> Column:
    """The shard of a key. All shards of weight 0 get nothing."""
    if _total(topology) <= 0:
        raise ValueError("a topology needs a shard with weight")
    return _pick(key, "", topology)


def assign(docs: DataFrame, topology: Topology, larger: Topology | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard (null without ``larger``)."""
    key = F.col("doc_id")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
    )
    rows = rows.select(
        "*", place(key, topology).alias("shard"), (place(key, larger) if larger else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    rows = materialise(rows, "shards")
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))  # at most BUCKETS rows a shard
    rank = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")) - 1
    out = rows.withColumn("rank", rank).join(F.broadcast(offsets), ["shard", "bucket"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank")).cast("long").alias("slot"), "grown_shard")


def op2_sharding_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    topology = even_topology()
    out = assign(table(spark, sf_dir, "documents").select("doc_id", "text"), topology, grown(topology))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
