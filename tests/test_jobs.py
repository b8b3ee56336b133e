"""Commands, external tools, lookups and manifests."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import cli
from voxloom.operators import layout, lookups, signal, tools
from voxloom.sources import audio, texts
from voxloom.sources.catalog import Catalog
from voxloom.sources.manifest import Manifest
from voxloom.sources.naming import dataset_name


@pytest.mark.parametrize(
    ("root", "want"),
    [("/data/ds.v1", "ds"), ("ds", "ds"), ("file:///a/b/", "b"), ("file:/a/b.c.d", "b.c"), ("store://repo/main/x", "repo"), ("store://repo/dev/x", "repo_dev"), ("store://repo", "repo")],
)
def test_dataset_name(root, want):
    assert dataset_name(root) == want


def test_lookups(spark):
    rows = spark.createDataFrame([("a", 1, None), ("b", 2, "own"), (None, 3, None)], "name string, n int, text string")
    known = spark.createDataFrame([("a", "A"), ("b", "B")], "name string, text string")
    plain = rows.drop("text")
    assert {r.n: r.text for r in lookups.lookup(plain, known, "name").collect()} == {1: "A", 2: "B", 3: None}
    assert {r.n: r.text for r in lookups.fill(rows, known, "name").collect()} == {1: "A", 2: "own", 3: None}
    assert {r.n: r.text for r in lookups.lookup_strict(plain.where("n < 3"), known, "name").collect()} == {1: "A", 2: "B"}
    with pytest.raises(Exception, match="no text for null"):
        lookups.lookup_strict(plain, known, "name").collect()
    assert lookups.lookup(plain.limit(0), known, "name").count() == 0


def test_spread(spark):
    rows = spark.range(2000).withColumnRenamed("id", "k")
    one, two = (lookups.spread(rows, "k", 7, seed).withColumn("p", F.spark_partition_id()).collect() for seed in (3, 3))
    assert one == two and sorted(r.k for r in one) == list(range(2000)) and [r.k for r in one] != sorted(r.k for r in one)
    assert [r.k for r in lookups.spread(rows, "k", 7, 4).collect()] != [r.k for r in one]
    sizes = [sum(r.p == p for r in one) for p in range(7)]
    assert min(sizes) > 200


def test_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "speaker string, n int")
    m = Manifest(spark, str(tmp_path / "done"), "speaker")
    assert m.pending(rows).count() == 3
    m.mark(rows.where("n <> 2"))
    m.mark(rows.where("n = 1"))
    assert sorted(r.n for r in m.pending(rows).collect()) == [2, 3] and m.done().count() == 1


def test_split_and_target(spark):
    rows = spark.createDataFrame([("/r/dev/audio/7/9/x.opus",), ("/r/other/audio/7/9/x.opus",)], "path string")
    parts = layout.audiobook_path(F.col("path"))
    target = layout.audiobook_target(F.lit(4), layout.checked_split(parts["split"]), parts["book"], parts["file_name"])
    assert rows.limit(1).select(target.alias("t")).head().t == "speaker_4/wavs/dev/9/x.wav"
    with pytest.raises(Exception, match="no split: other"):
        rows.select(target.alias("t")).collect()


def test_pieces(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],), ([1.0, 2.0],), ([],), (None,)], "x array<float>")
    assert [r.p for r in rows.select(signal.pieces(F.col("x"), 2).alias("p")).collect()] == [[[1, 2], [3, 4], [5]], [[1, 2]], None, None]


def test_transcode(spark):
    def double(source: str, target: str) -> None:
        if source.endswith(".bad"):
            raise ValueError("not audio")
        Path(target).write_bytes(Path(source).read_bytes() * 2)

    files = spark.createDataFrame([("/a.mp3", b"ab", "a.wav"), ("/b.bad", b"b", "b.wav"), ("/c.mp3", b"c", "c.wav")], "path string, content binary, path_to_wav string")
    there = spark.createDataFrame([("c.wav",)], "path_to_wav string")
    out = {r.path_to_wav: (r.content, r.error) for r in tools.transcode(files, double, there).collect()}
    assert out == {"a.wav": (bytearray(b"abab"), None), "b.wav": (None, "ValueError: not audio")}
    assert tools.transcode(files.limit(0), double).count() == 0
    assert tools.transcode(files, tools.command("cp", "{source}", "{target}")).where("content IS NULL").count() == 0


def test_align(spark):
    def aligner(clip: str, text: str, grid: str) -> None:
        words = Path(text).read_text().split()
        if words[0] == "fail":
            raise RuntimeError("no alignment")
        each = "".join(f'  intervals [{i + 1}]:\n   xmin = {i}\n   xmax = {i + 1}\n   text = "{w}"\n' for i, w in enumerate(words))
        Path(grid).write_text("item []:\n item [1]:\n" + each)
        if words[0] == "late":
            raise RuntimeError("after the grid")

    clips = spark.createDataFrame([("h1", b"1", "well-known fact"), ("h2", b"2", "fail here"), ("h3", b"3", "late word"), ("h4", b"4", None)], "hash string, content binary, text string")
    got = tools.align(clips, aligner).select("hash", texts.parse_textgrid(F.col("grid")).alias("i")).collect()
    assert {r.hash: r.i and [x.text for x in r.i] for r in got} == {"h1": ["well", "known", "fact"], "h2": None, "h3": ["late", "word"]}


def test_commands(spark, tmp_path):
    root, store = tmp_path / "voices.v1", str(tmp_path / "catalog")
    (root / "wavs").mkdir(parents=True)
    lines = ["path_to_wav|speaker_id|text"]
    for i in range(4):
        wave = np.sin(np.arange(16000 * (i + 1)) / 20) * 0.5
        (root / "wavs" / f"{i}.wav").write_bytes(audio.wav_bytes(wave, 16000))
        lines.append(f"wavs/{i}.wav|{i % 2}|words of clip {i}")
    (root / "metadata.csv").write_text("\n".join(lines) + "\n")
    config = tmp_path / "config.yaml"
    config.write_text("default:\n  sample_rate: 16000\n  duration:\n    min: 2\n    max: 3.5\n")
    cli.main(["audio-metrics", "--catalog", store, "--dataset", str(root), "--save-path", str(tmp_path / "hashed")], spark)
    cli.main(["texts", "--catalog", store, "--dataset", str(root)], spark)
    catalog = Catalog(spark, store)
    assert catalog.read("audio_metrics").count() == 4 and {r.dataset_name for r in catalog.read("audio_to_dataset").collect()} == {"voices"}
    hashed = spark.read.option("sep", "|").option("header", True).csv(str(tmp_path / "hashed"))
    assert hashed.where("hash IS NOT NULL").count() == 4
    first = {r.audio_md5_hash: r.text for r in catalog.read("audio_to_original_text").collect()}
    catalog.insert_new("audio_to_asr_text", catalog.read("audio_to_original_text").withColumn("text", F.replace("text", F.lit("words"), F.lit("birds"))))
    cli.main(["error-rates", "--catalog", store], spark)
    assert len(first) == 4 and {r.WER for r in catalog.read("text_comparation_metrics").collect()} == {0.25}
    saved = str(tmp_path / "found")
    cli.main(["filter", "--catalog", store, "--dataset", str(root), "--path-to-config", str(config), "--include-text", "--save-path", saved, "--single-file"], spark)
    rows = spark.read.option("sep", "|").option("header", True).csv(saved).collect()
    assert sorted(r.path_to_wav for r in rows) == ["wavs/1.wav", "wavs/2.wav"] and {r.text for r in rows} == {"words of clip 1", "words of clip 2"}
    assert len([f for f in os.listdir(saved) if f.endswith(".csv")]) == 1
