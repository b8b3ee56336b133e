"""External programs run once a clip: transcoders and forced aligners.

A tool is a function of paths in a folder of its own, which goes when the clip is done; ``command`` makes one of a
program's arguments. Contents go in and out as columns, so that clips may be in any store that Spark reads.
"""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def command(*arguments: str, timeout: float = 600) -> Callable[..., None]:
    """A tool that runs a program; ``{name}`` in arguments stands for the tool's path of that name."""

    def run(**paths: str) -> None:
        subprocess.run([a.format(**paths) for a in arguments], check=True, capture_output=True, timeout=timeout)

    return run


def ffmpeg() -> Callable[..., None]:
    """Any audio to mono WAV of 16-bit samples."""
    return command("ffmpeg", "-y", "-i", "{source}", "-acodec", "pcm_s16le", "-ac", "1", "{target}")


def transcode(files: DataFrame, tool: Callable[..., None], existing: DataFrame | None = None) -> DataFrame:
    """path_to_wav, content, error of files (path, content, path_to_wav) as the tool's WAV files.

    Targets in ``existing`` (path_to_wav) are left out. A file that the tool fails on has null content and the error.
    """
    todo = files if existing is None else files.join(existing.select("path_to_wav"), "path_to_wav", "left_anti")

    def one(path: str, content: bytes) -> tuple[bytes | None, str | None]:
        with tempfile.TemporaryDirectory(prefix="voxloom-tool-") as at:
            source, target = Path(at, f"source{Path(path).suffix}"), Path(at, "target.wav")
            source.write_bytes(content)
            try:
                tool(source=str(source), target=str(target))
                return target.read_bytes(), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [one(p, c) for p, c in zip(frame["path"], frame["content"], strict=True)]
            yield pd.DataFrame({"path_to_wav": frame["path_to_wav"], "content": [m[0] for m in made], "error": [m[1] for m in made]})

    return todo.select("path", "content", "path_to_wav").mapInPandas(run, "path_to_wav string, content binary, error string")


def align(clips: DataFrame, tool: Callable[..., None]) -> DataFrame:
    """hash, grid: the TextGrid of each clip (hash, content, text), null where the tool made none.

    Hyphens are blanks to the tool. A failing tool doesn't stop the job, and a grid that it left before failing counts.
    Clips without text aren't aligned.
    """

    def one(content: bytes, text: str) -> str | None:
        with tempfile.TemporaryDirectory(prefix="voxloom-tool-") as at:
            clip, words, grid = Path(at, "clip.wav"), Path(at, "clip.txt"), Path(at, "clip.TextGrid")
            clip.write_bytes(content)
            words.write_text(text, encoding="utf-8")
            try:
                tool(clip=str(clip), text=str(words), grid=str(grid))
            except Exception:
                pass  # judged by the grid alone
            return grid.read_text(encoding="utf-8") if grid.exists() else None

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"hash": frame["hash"], "grid": [one(c, t) for c, t in zip(frame["content"], frame["text"], strict=True)]})

    said = clips.where("text IS NOT NULL").select("hash", "content", F.replace("text", F.lit("-"), F.lit(" ")).alias("text"))
    return said.mapInPandas(run, "hash string, grid string")
