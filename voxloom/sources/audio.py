"""Audio files: discovery, checksums, WAV headers and samples, WAV output."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes of audio files, case-sensitive.
EXTENSIONS = ("mp3", "mp4", "wav", "aiff", "flac", "opus", "webm", "ogg")
_PCM = {1: "PCM_U8", 2: "PCM_16", 3: "PCM_24", 4: "PCM_32"}
INFO = "path string, sample_rate int, channels int, pcm_format string, duration_seconds double"
DECODED = INFO + ", samples array<double>"


def find_audio(spark: SparkSession, root: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """path, modificationTime, length, content of audio files under root; content is only read where it is used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{','.join(extensions)}}}").load(root)


def checksums(files: DataFrame) -> DataFrame:
    return files.select("path", F.md5("content").alias("hash"))


def pcm(content: bytes) -> tuple[wave._wave_params, np.ndarray] | None:
    """Header and interleaved samples in [-1, 1); None for what isn't a WAV file."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            p, raw = w.getparams(), w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return None
    if p.sampwidth == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 2] << 24) | (b[:, 1] << 16) | (b[:, 0] << 8)) / 2**31
    elif p.sampwidth == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    else:
        x = np.frombuffer(raw, f"<i{p.sampwidth}") / 2.0 ** (8 * p.sampwidth - 1)
    return p, x


def decode(files: DataFrame, with_samples: bool = False) -> DataFrame:
    """Header (and samples) of WAV files; files that can't be read give no row."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                if (found := pcm(bytes(content))) is None:
                    continue
                p, x = found
                rows.append((path, p.framerate, p.nchannels, _PCM[p.sampwidth], p.nframes / p.framerate, *([x.tolist()] if with_samples else [])))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in (DECODED if with_samples else INFO).split(", ")])

    return files.select("path", "content").mapInPandas(run, DECODED if with_samples else INFO)


def wav_bytes(samples: np.ndarray, rate: int, channels: int = 1) -> bytes:
    """16-bit PCM of samples in [-1, 1]."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(samples), -1, 1 - 2**-15) * 2**15).round().astype("<i2").tobytes())
    return out.getvalue()


def write_wavs(rows: DataFrame, root: str, rate: int, path: str = "path_to_wav", samples: str = "samples") -> DataFrame:
    """Writes each row's samples under root, a folder that all executors share; path and whether it was written (not if it was there)."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        for frame in frames:
            done = []
            for p, x in zip(frame[path], frame[samples], strict=True):
                target = os.path.join(root, p)
                new = not os.path.exists(target)
                if new:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    with open(f"{target}.{os.getpid()}", "wb") as f:
                        f.write(wav_bytes(x, rate))
                    os.replace(f"{target}.{os.getpid()}", target)
                done.append(new)
            yield pd.DataFrame({path: frame[path], "written": done})

    return rows.select(path, samples).mapInPandas(run, f"{path} string, written boolean")


def missing(wanted: DataFrame, present: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose file isn't in a listing."""
    return wanted.join(present.select(path).distinct(), path, "left_anti")
