"""Incremental runs as streams: what files bring is upserted batch by batch; the checkpoint is the resume point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import TABLES
from ..sources.catalog import Catalog


def upsert_stream(spark: SparkSession, source: str, table: str, catalog: Catalog, checkpoint: str) -> StreamingQuery:
    """Upserts new Parquet files of ``source`` into a table and stops. A batch that runs twice leaves the same table."""
    schema, keys = TABLES[table]
    rows = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(source)

    def batch(frame: DataFrame, _: int) -> None:
        catalog.upsert(table, frame.dropDuplicates(keys))

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_stream(rows: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """First row of each key within the watermark; state older than that is dropped."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
