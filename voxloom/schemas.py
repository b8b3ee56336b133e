"""Schemas of the clip catalogue. ``cps`` is nullable; every other column of a stored row is set."""

from __future__ import annotations

AUDIO_METRICS = "audio_md5_hash string, duration_seconds double, sample_rate int, channels int, pcm_format string, SNR double, dBFS double"
AUDIO_TO_DATASET = "id long, audio_md5_hash string, dataset_name string, path_to_file string, speaker_id int"
AUDIO_TO_TEXT = "audio_md5_hash string, text string, cps double"
TEXT_METRICS = "audio_md5_hash string, WER double, CER double"
ALIGNMENTS = "audio_md5_hash string, mfa_textgrid_data string"
INTERVALS = "array<struct<text:string,min_time:double,max_time:double,duration:double>>"
METADATA = "path_to_wav string, speaker_id int, text string, hash string"
#: table -> (schema, key columns)
TABLES = {
    "audio_metrics": (AUDIO_METRICS, ["audio_md5_hash"]),
    "audio_to_dataset": (AUDIO_TO_DATASET, ["audio_md5_hash", "dataset_name"]),
    "audio_to_original_text": (AUDIO_TO_TEXT, ["audio_md5_hash"]),
    "audio_to_asr_text": (AUDIO_TO_TEXT, ["audio_md5_hash"]),
    "text_comparation_metrics": (TEXT_METRICS, ["audio_md5_hash"]),
    "audio_to_mfa_data": (ALIGNMENTS, ["audio_md5_hash"]),
}
#: Speaker id of clips whose speaker isn't known.
UNKNOWN_SPEAKER = -1
