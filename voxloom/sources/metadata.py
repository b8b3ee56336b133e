"""Readers and writer of pipe-separated metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CSV = {"sep": "|", "header": True, "quote": '"', "escape": '"'}


def read_metadata(spark: SparkSession, path: str, schema: str | None = None, distinct: bool = True, required: tuple[str, ...] = ("path_to_wav", "speaker_id")) -> DataFrame:
    """Rows of a metadata file, without repeated ones; required columns must be there."""
    header = spark.read.options(**_CSV).csv(path).columns
    if missing := [c for c in required if c not in header]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    rows = spark.read.options(**_CSV).csv(path)
    if schema:
        types = {c.split()[0]: c.split()[1] for c in schema.split(", ")}
        rows = rows.select(*(F.col(c).cast(types.get(c, "string")).alias(c) for c in header))
    return rows.distinct() if distinct else rows


def with_hash(rows: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """rows with the MD5 of their files' bytes where ``hash`` is missing. files: path, content."""
    sums = files.select(F.regexp_replace("path", "^(file:)?/*", "/").alias("_file"), F.md5("content").alias("_md5"))
    target = F.regexp_replace(F.concat(F.lit(root.rstrip("/") + "/"), F.col("path_to_wav")), "^(file:)?/*", "/")
    found = rows.withColumn("_file", target).join(sums, "_file", "left")
    old = F.col("hash") if "hash" in rows.columns else F.lit(None).cast("string")
    return found.withColumn("hash", F.coalesce(old, "_md5")).drop("_file", "_md5")


def write_metadata(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Pipe-separated with a header; one file only on request, as that is one task."""
    (rows.coalesce(1) if single_file else rows).write.options(**_CSV).mode("overwrite").csv(path)
