"""Per-speaker caps and floors, on the whole dataset before any quality filter.

Both need a maximum to act; a lone minimum does nothing. Clips of a speaker are taken in order of ``id``, then
hash. Speakers are window partitions: the unknown speaker is one of them, and windows spill. Durations are added as
decimals, so that a sum which meets a bound exactly does so in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_ORDER = ("id", "audio_md5_hash")


def samples_per_speaker(clips: DataFrame, maximum: int | None, minimum: int | None = None) -> DataFrame | None:
    """Hashes to keep: the first ``maximum`` of larger speakers, none of those under ``minimum``, all of others.

    Counts are a partial aggregate joined back; only speakers over the cap are ranked.
    """
    if maximum is None:
        return None
    counts = clips.groupBy("speaker_id").agg(F.count("audio_md5_hash").alias("cnt"))
    floor = F.lit(True) if minimum is None else F.col("cnt") >= minimum
    counted = clips.join(counts, "speaker_id")
    kept = counted.where((F.col("cnt") <= maximum) & floor).select("audio_md5_hash")
    ranked = counted.where(F.col("cnt") > maximum).withColumn("rn", F.row_number().over(W.partitionBy("speaker_id").orderBy(*_ORDER)))
    return kept.unionByName(ranked.where(F.col("rn") <= maximum).select("audio_md5_hash"))


def _seconds(window) -> Column:
    """Sum of ``d``, rounded once: decimals to 15 places; what no such decimal holds (not finite, beyond 10^13) is added as it is. Null where all are null."""
    exact = F.col("d").try_cast("decimal(28,15)")
    rest = F.when(exact.isNull(), F.col("d")).otherwise(0.0)
    return F.coalesce(F.sum(exact).over(window).cast("double"), F.lit(0.0)) + F.sum(rest).over(window)


def minutes_per_speaker(clips: DataFrame, metrics: DataFrame, maximum: float | None, minimum: float | None = None, strict_minutes: bool = False) -> DataFrame | None:
    """Hashes to keep: of speakers over ``maximum`` minutes the clips up to and including the one that crosses it,
    none of speakers under ``minimum`` seconds (minutes if strict) or without metrics, all of others."""
    if maximum is None:
        return None
    limit = float(maximum) * 60
    floor_at = None if minimum is None else float(minimum) * (60 if strict_minutes else 1)
    timed = clips.join(metrics.select("audio_md5_hash", F.col("duration_seconds").alias("d")), "audio_md5_hash", "left")
    speaker = W.partitionBy("speaker_id")
    prefix = F.coalesce(_seconds(speaker.orderBy(F.col("d").isNull(), *_ORDER).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    each = timed.withColumn("t", _seconds(speaker)).withColumn("before", prefix)
    floor = F.lit(True) if floor_at is None else F.col("t") >= floor_at
    keep = F.when(F.col("t") > limit, F.col("d").isNotNull() & (F.col("before") <= limit)).otherwise(F.col("t").isNotNull() & floor)
    return each.where(keep).select("audio_md5_hash")


def intersect(clips: DataFrame, *kept: DataFrame | None) -> DataFrame:
    """Clips in every cap's result."""
    for k in kept:
        if k is not None:
            clips = clips.join(k.distinct(), "audio_md5_hash", "left_semi")
    return clips
