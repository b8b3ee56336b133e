"""Incremental jobs that fill the catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignment, incremental, models, signal, text_metrics
from ..sources import audio, metadata
from ..sources.catalog import Catalog


def collect_audio_metrics(catalog: Catalog, root: str, dataset: str, overwrite: bool = False) -> DataFrame:
    """Metrics and membership of all clips of a dataset folder; returns its metadata with hashes."""
    spark = catalog.spark
    rows = metadata.read_metadata(spark, f"{root}/metadata.csv", "speaker_id int")
    files = audio.find_audio(spark, root, ("wav",))
    known = incremental.keep_first(metadata.with_hash(rows, files, root).where("hash IS NOT NULL"), "hash", ["path_to_wav"])
    strip = F.regexp_replace("path", "^(file:)?/*", "/")
    paths = known.select("hash", F.regexp_replace(F.concat(F.lit(root.rstrip("/") + "/"), "path_to_wav"), "^(file:)?/*", "/").alias("_p"))
    todo = paths if overwrite else paths.join(catalog.read("audio_metrics").select(F.col("audio_md5_hash").alias("hash")), "hash", "left_anti")
    wanted = files.withColumn("_p", strip).join(todo, "_p").select(F.col("hash").alias("path"), "content")
    decoded = audio.decode(wanted, with_samples=True)
    first = F.filter("samples", lambda x, i: i % F.col("channels") == 0)
    rows_new = decoded.select(F.col("path").alias("audio_md5_hash"), "duration_seconds", "sample_rate", "channels", "pcm_format", signal.snr(first).alias("SNR"), signal.dbfs(F.col("samples")).alias("dBFS"))
    write = catalog.upsert if overwrite else catalog.insert_new
    write("audio_metrics", rows_new)
    members = known.select(F.xxhash64("hash", F.lit(dataset)).alias("id"), F.col("hash").alias("audio_md5_hash"), F.lit(dataset).alias("dataset_name"), F.col("path_to_wav").alias("path_to_file"), "speaker_id")
    write("audio_to_dataset", members)
    return known


def collect_texts(catalog: Catalog, rows: DataFrame, overwrite: bool = False, table: str = "audio_to_original_text", text: str = "text") -> None:
    """Texts and characters a second of rows (hash, text)."""
    seconds = catalog.read("audio_metrics").select(F.col("audio_md5_hash").alias("hash"), "duration_seconds")
    found = rows.where(F.col(text).isNotNull()).join(seconds, "hash", "left")
    out = found.select(F.col("hash").alias("audio_md5_hash"), F.col(text).alias("text"), text_metrics.cps(F.col(text), F.col("duration_seconds")).alias("cps"))
    (catalog.upsert if overwrite else catalog.insert_new)(table, out)


def recognise(catalog: Catalog, clips: DataFrame, load: Callable, batch: int = 10) -> None:
    """Recognised texts of clips (hash, samples) that have none; characters a second are those of the recognised text."""
    todo = clips.join(catalog.read("audio_to_asr_text").select(F.col("audio_md5_hash").alias("hash")), "hash", "left_anti")
    done = models.processed(models.run_model(todo, "hash", "samples", load, "recognized_text", "string", batch), "recognized_text")
    collect_texts(catalog, done, table="audio_to_asr_text", text="recognized_text")


def collect_error_rates(catalog: Catalog, overwrite: bool = False) -> DataFrame:
    """Error rates of clips with both texts; returns the coverage report made before."""
    original = catalog.read("audio_to_original_text").select("audio_md5_hash", F.col("text").alias("r"))
    recognised = catalog.read("audio_to_asr_text").select("audio_md5_hash", F.col("text").alias("h"))
    done = catalog.read("text_comparation_metrics")
    report = incremental.coverage(catalog.read("audio_to_dataset"), original, recognised, done)
    pairs = original.join(recognised, "audio_md5_hash")
    pairs = pairs if overwrite else incremental.new_rows(pairs, done, ["audio_md5_hash"])
    rates = pairs.select("audio_md5_hash", text_metrics.wer(F.col("r"), F.col("h")).alias("WER"), text_metrics.cer(F.col("r"), F.col("h")).alias("CER")).where("WER IS NOT NULL")
    counted = catalog.spark.createDataFrame(report.collect(), report.schema)
    (catalog.upsert if overwrite else catalog.insert_new)("text_comparation_metrics", rates)
    return counted


def collect_alignments(catalog: Catalog, rows: DataFrame, overwrite: bool = False) -> None:
    """Intervals (hash, intervals) as JSON."""
    out = rows.where("intervals IS NOT NULL").select(F.col("hash").alias("audio_md5_hash"), alignment.to_json(F.col("intervals")).alias("mfa_textgrid_data"))
    (catalog.upsert if overwrite else catalog.insert_new)("audio_to_mfa_data", out)
