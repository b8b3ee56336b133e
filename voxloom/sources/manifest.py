"""Which keys a job has finished, so that it can go on where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Manifest:
    """Finished keys as Parquet under ``path``; a key that is marked twice counts once."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def done(self) -> DataFrame:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        there = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        schema = f"{self.key} string"
        return self.spark.read.schema(schema).parquet(self.path).distinct() if there else self.spark.createDataFrame([], schema)

    def pending(self, rows: DataFrame) -> DataFrame:
        """rows whose key isn't marked; rows with a null key always are pending."""
        done = self.done().withColumnRenamed(self.key, "_done")
        return rows.join(done, F.col(self.key).cast("string") == F.col("_done"), "left_anti")

    def mark(self, rows: DataFrame) -> None:
        rows.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast("string").alias(self.key)).distinct().write.mode("append").parquet(self.path)
