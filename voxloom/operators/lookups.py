"""Texts looked up by name or hash, and rows dealt evenly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, texts: DataFrame, on: str, value: str = "text") -> DataFrame:
    """rows with ``value`` of texts, which has a row for each ``on`` at most; null where there is none."""
    return rows.join(texts.select(on, value), on, "left")


def lookup_strict(rows: DataFrame, texts: DataFrame, on: str, value: str = "text") -> DataFrame:
    """As lookup, but a row whose ``on`` is null or not in texts raises when it is read."""
    found = rows.join(texts.select(on, value, F.lit(True).alias("_there")), on, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {value} for "), F.coalesce(F.col(on).cast("string"), F.lit("null"))))
    return found.withColumn(value, F.when(F.col("_there"), F.col(value)).otherwise(missing)).drop("_there")


def fill(rows: DataFrame, texts: DataFrame, on: str, value: str = "text") -> DataFrame:
    """rows with their own ``value``, or that of texts where theirs is null."""
    other = texts.select(on, F.col(value).alias("_other"))
    return rows.join(other, on, "left").withColumn(value, F.coalesce(value, "_other")).drop("_other")


def spread(rows: DataFrame, key: str, parts: int, seed: int = 0) -> DataFrame:
    """rows dealt to ``parts`` tasks in shuffled order. Both follow from key and seed, so that a repeated task gets the same rows."""
    return rows.repartition(parts, F.xxhash64(F.lit(seed), key)).sortWithinPartitions(F.xxhash64(F.lit(seed + 1), key), key)
