"""Semi and anti joins by key, deduplication and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def new_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(existing.select(*keys).distinct(), keys, "left_anti")


def existing_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(existing.select(*keys).distinct(), keys, "left_semi")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with rows of new in place of those with equal keys."""
    return new_rows(old, new, keys).unionByName(new)


def keep_first(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_n(rows: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first n rows of each group; -1 for all."""
    if n < 0:
        return rows
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def coverage(dataset: DataFrame, left: DataFrame, right: DataFrame, done: DataFrame, key: str = "audio_md5_hash") -> DataFrame:
    """total, pairs (keys on both sides), percentage, to_add and to_update (pairs that done has not, or has)."""
    flag = lambda df, n: df.select(key).distinct().withColumn(n, F.lit(True))
    all_ = dataset.select(key).distinct().join(flag(left, "l"), key, "left").join(flag(right, "r"), key, "left").join(flag(done, "d"), key, "left")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    return all_.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(both).alias("pairs"),
        F.try_divide(F.count_if(both) * 100.0, F.count(F.lit(1))).alias("percentage"),
        F.count_if(both & F.col("d").isNull()).alias("to_add"), F.count_if(both & F.col("d").isNotNull()).alias("to_update"),
    )
