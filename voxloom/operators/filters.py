"""Predicates of a filter configuration, as columns over the joined clip table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_SPEAKER


def in_range(column: str, bounds: dict | None) -> Column | None:
    """Inclusive; either bound may be missing; none without bounds."""
    parts = [op(F.col(column), F.lit(v)) for v, op in (((bounds or {}).get("min"), Column.__ge__), ((bounds or {}).get("max"), Column.__le__)) if v is not None]
    return reduce(Column.__and__, parts) if parts else None


def equals(column: str, value: object) -> Column | None:
    return F.col(column) == value if value is not None else None


#: Configuration key -> column of the joined table.
RANGES = {"duration": "duration_seconds", "SNR": "SNR", "dBFS": "dBFS", "CER": "CER", "WER": "WER", "CPS": "asr_cps"}
EQUALS = {"sample_rate": "sample_rate", "channels": "channels"}


def predicates(config: dict) -> list[Column]:
    """All predicates that a configuration sets, unknown keys ignored."""
    found = [equals(c, config.get(k)) for k, c in EQUALS.items()] + [in_range(c, config.get(k)) for k, c in RANGES.items()]
    if config.get("use_unknown_speakers") is False:
        found.append(F.col("speaker_id") != UNKNOWN_SPEAKER)
    if config.get("only_with_ASR_texts"):
        found.append(F.col("asr_text").isNotNull())
    if config.get("only_with_Original_texts"):
        found.append(F.col("original_text").isNotNull())
    return [p for p in found if p is not None]


def conjunction(parts: list[Column]) -> Column:
    return reduce(Column.__and__, parts, F.lit(True))
