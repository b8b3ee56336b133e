"""Distributed connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: neighbours of each node are linked to the smallest node around it.

    The minimum is a partial aggregate, so a hub costs one row a task; the join back to the edges is an
    ordinary sort-merge join, whose hot keys the adaptive planner splits.
    """
    if large:
        around = edges.union(edges.select("dst", "src"))
    else:
        around = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = around.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    joined = around.join(least, "src")
    if large:
        out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    else:
        out = joined.select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(least.select("src", F.col("m").alias("dst")))
    return out.where("src <> dst").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).head())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst); component is its smallest node.

    Edges with a null end and loops count for nothing. Every round is written to the shared folder, and the one before it removed. Rounds
    grow with the logarithm of the longest path; ``max_rounds`` only guards against a fault and raises.
    """
    now = materialise(edges.select("src", "dst").where("src <> dst").distinct(), "edges", free=True)
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        last, now = now, materialise(_star(_star(now, large=True), large=False), "edges", free=True)
        discard(last)
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError("connected components didn't settle")
    out = now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(now.select("dst", "dst").distinct())
    out._scratch = now._scratch  # for a caller that discards it
    return out
