"""Signal metrics and chunking over arrays of samples."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import let


def channel(samples: Column, channels: int, k: int = 0) -> Column:
    """Samples of channel k of interleaved ones."""
    return F.filter(samples, lambda x, i: i % channels == k)


def downmix(samples: Column, channels: int) -> Column:
    """Mean over channels, frame by frame."""
    frames = F.sequence(F.lit(0), (F.size(samples) / channels).cast("int") - 1)
    total = lambda i: sum((F.get(samples, i * channels + k).cast("double") for k in range(channels)), F.lit(0.0))
    return F.when(F.size(samples) >= channels, F.transform(frames, lambda i: total(i) / channels)).otherwise(F.array().cast("array<double>"))


def mean(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(samples)


def snr(samples: Column) -> Column:
    """Mean over population deviation; 0 without deviation; null without samples."""

    def squared(m: Column) -> Column:
        return F.aggregate(samples, F.lit(0.0), lambda a, x: a + (x.cast("double") - m) * (x.cast("double") - m))

    def ratio(m: Column) -> Column:
        return let(F.sqrt(squared(m) / F.size(samples)), lambda sd: F.when(sd == 0, 0.0).otherwise(m / sd))

    return F.when(F.size(samples) > 0, let(mean(samples), ratio))


def dbfs(samples: Column, full_scale: float = 1.0) -> Column:
    """Root mean square relative to full scale, in decibels; -inf for silence."""
    rms = F.sqrt(F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / F.size(samples))
    return F.when(F.size(samples) > 0, F.when(rms == 0, float("-inf")).otherwise(20 * F.log10(rms / full_scale)))


def chunks(samples: Column, length: int, overlap: int) -> Column:
    """Frames of ``length`` at every ``length - overlap``, the last padded with zeros."""
    hop = length - overlap
    starts = F.sequence(F.lit(0), F.size(samples) - 1, F.lit(hop))
    padded = lambda s: F.concat(s, F.array_repeat(F.lit(0.0).cast("float"), F.lit(length) - F.size(s)))
    return F.when(F.size(samples) > 0, F.transform(starts, lambda i: padded(F.slice(samples, i + 1, F.lit(length)))))


def pieces(samples: Column, length: int) -> Column:
    """Consecutive pieces of ``length`` samples, the last as long as what is left; null without samples."""
    starts = F.sequence(F.lit(0), F.size(samples) - 1, F.lit(length))
    return F.when(F.size(samples) > 0, F.transform(starts, lambda i: F.slice(samples, i + 1, F.lit(length))))


#: Divisor of silent chunks; roll-off and Kaiser beta of the resampler.
SILENCE = 10e-7
ROLLOFF, BETA = 0.9475937167399596, 14.769656459379492


def peak_normalize(chunk: Column) -> Column:
    """Divided by the largest absolute sample, or by 1e-6 in silence."""
    peak = F.array_max(F.transform(chunk, lambda x: F.abs(x.cast("double"))))
    return let(F.when(peak == 0, SILENCE).otherwise(peak), lambda p: F.transform(chunk, lambda x: x.cast("double") / p))


def overlap_add(rows: DataFrame, key: str, length: int, overlap: int) -> DataFrame:
    """key, pos, value: chunks (key, n, i, chunk; n samples in all) faded linearly into each other and summed, cut to n."""
    hop = length - overlap
    each = rows.select(key, "n", "i", F.posexplode("chunk").alias("j", "x"))
    last = F.floor((F.col("n") - 1) / hop)
    step = 1.0 / (overlap - 1) if overlap > 1 else 0.0
    rise = F.when((F.col("i") > 0) & (F.col("j") < overlap), F.col("j") * step).otherwise(1.0)
    fall = F.when((F.col("i") < last) & (F.col("j") >= hop), (F.lit(length - 1) - F.col("j")) * step).otherwise(1.0)
    placed = each.select(key, (F.col("i") * hop + F.col("j")).cast("int").alias("pos"), "n", (F.col("x") * rise * fall).alias("v"))
    return placed.where("pos < n").groupBy(key, "pos").agg(F.sum("v").alias("value"))


def resample_array(x: np.ndarray, source: int, target: int, width: int = 64, rolloff: float = ROLLOFF, beta: float = BETA) -> np.ndarray:
    """Windowed-sinc (Kaiser) resampling."""
    if source == target or not len(x):
        return np.asarray(x, np.float64)
    cut = min(source, target) * rolloff / source
    n = int(np.ceil(len(x) * target / source))
    at = np.arange(n) * source / target
    reach = int(np.ceil(width / cut))
    offsets = np.arange(-reach, reach + 1)
    index = np.floor(at).astype(int)[:, None] + offsets
    delta = at[:, None] - index
    inside = np.clip(1 - (delta * cut / width) ** 2, 0, None)
    kernel = np.sinc(delta * cut) * np.i0(beta * np.sqrt(inside)) / np.i0(beta) * cut * (np.abs(delta * cut) <= width)
    padded = np.where((index >= 0) & (index < len(x)), np.asarray(x, np.float64)[np.clip(index, 0, len(x) - 1)], 0.0)
    return (padded * kernel).sum(1)


def resample(rows: DataFrame, key: str, samples: str, source: int, target: int) -> DataFrame:
    """key, samples at the target rate; Arrow batches."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], samples: [resample_array(np.asarray(x), source, target).tolist() for x in b[samples]]})

    return rows.select(key, samples).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {samples} array<double>")


def mel_bank(rate: int, size: int, bands: int) -> np.ndarray:
    """Triangular filters, evenly spaced in mels."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    points = 700 * (10 ** (np.linspace(0, mel(rate / 2), bands + 2) / 2595) - 1)
    f = np.linspace(0, rate / 2, size // 2 + 1)
    up = (f - points[:-2, None]) / (points[1:-1] - points[:-2])[:, None]
    down = (points[2:, None] - f) / (points[2:] - points[1:-1])[:, None]
    return np.clip(np.minimum(up, down), 0, None)


def mel_offset(a: np.ndarray, b: np.ndarray, rate: int, bands: int = 80, hop_seconds: float = 0.005) -> int:
    """Samples by which b lags a: the peak of the circular cross-correlation of log mel spectrograms."""
    hop = max(1, int(rate * hop_seconds))
    window, size = 4 * hop, 1 << max(1, (4 * hop - 1).bit_length())
    bank = mel_bank(rate, size, bands)

    def spectrogram(x: np.ndarray) -> np.ndarray:
        x = np.pad(np.asarray(x, np.float64), size // 2)
        frames = np.stack([x[i : i + window] for i in range(0, len(x) - window + 1, hop)]) * np.hanning(window + 1)[:-1]
        return np.log1p(bank @ (np.abs(np.fft.rfft(frames, size)) ** 2).T)

    sa, sb = spectrogram(a), spectrogram(b)
    n = max(sa.shape[1], sb.shape[1])
    correlation = np.fft.irfft(np.conj(np.fft.rfft(sa, n)) * np.fft.rfft(sb, n), n).mean(0)
    lag = int(correlation.argmax())
    return (lag - n if lag > n // 2 else lag) * hop
