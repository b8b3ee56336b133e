"""Which clips of a dataset pass a configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import caps, filters


def joined(tables: dict[str, DataFrame], dataset: str, arms: set[str]) -> DataFrame:
    """Clips of the dataset with the tables that are needed; each is unique by hash, so nothing fans out."""
    out = tables["audio_to_dataset"].where(F.col("dataset_name") == dataset)
    if "metrics" in arms:
        out = out.join(tables["audio_metrics"], "audio_md5_hash", "left")
    if "errors" in arms:
        out = out.join(tables["text_comparation_metrics"], "audio_md5_hash", "left")
    original = tables["audio_to_original_text"].select("audio_md5_hash", F.col("text").alias("original_text"))
    recognised = tables["audio_to_asr_text"].select("audio_md5_hash", F.col("text").alias("asr_text"), F.col("cps").alias("asr_cps"))
    return out.join(original, "audio_md5_hash", "left").join(recognised, "audio_md5_hash", "left")


def filter_dataset(tables: dict[str, DataFrame], dataset: str, config: dict) -> DataFrame:
    """path_to_wav, speaker_id, hash, original_text, asr_text of clips that pass. Arms that nothing asks for aren't joined."""
    arms = {"metrics"} if any(config.get(k) for k in ("sample_rate", "channels", "duration", "SNR", "dBFS")) else set()
    arms |= {"errors"} if any(config.get(k) for k in ("CER", "WER")) else set()
    found = joined(tables, dataset, arms).where(filters.conjunction(filters.predicates(config)))
    clips = tables["audio_to_dataset"].where(F.col("dataset_name") == dataset)
    s, m = config.get("samples_per_speaker") or {}, config.get("minutes_per_speaker") or {}
    found = caps.intersect(found, caps.samples_per_speaker(clips, s.get("max"), s.get("min")), caps.minutes_per_speaker(clips, tables["audio_metrics"], m.get("max"), m.get("min")))
    return found.select(F.col("path_to_file").alias("path_to_wav"), "speaker_id", F.col("audio_md5_hash").alias("hash"), "original_text", "asr_text")


def with_text(found: DataFrame, include_text: bool = False) -> DataFrame:
    """The result with one text column, rows without text gone; or without text columns."""
    if not include_text:
        return found.drop("original_text", "asr_text")
    return found.withColumn("text", F.coalesce("original_text", "asr_text")).drop("original_text", "asr_text").na.drop(subset=["text"])
