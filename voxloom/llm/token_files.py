"""Token-id files: every document a zstandard frame of its own, all compressed with one shared dictionary.

Layout of a file (little-endian)::

    magic "VXTF" | u16 version | u16 bytes per id | 32 bytes SHA-256 of the dictionary
    one zstandard frame per document: its ids, serialized in that width
    offset index: u64 start of each frame and of the end, u32 ids per document, i64 document id, u8 1 if the id is null
    u64 position of the index | u64 number of documents | magic "VXTF"

The dictionary lies beside the files as ``<sha256>.zdict`` and is trained on the serialized ids of a bounded
sample (``SAMPLE`` documents of at most ``SAMPLE_BYTES``, those with the smallest hashed id). A reader that
wants one document reads the tail, the index entry and the frame, nothing else.

Documents are range-partitioned and sorted by id, so the files in their order hold ascending ids. A task
writes under a name of its own attempt and reports it; only reported files are read, so a lost or repeated
attempt leaves nothing that counts.

Cases: null text is empty and holds only the end id; null ids sort first; equal ids are ordered by text;
an empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, sample_texts, scratch, ship, shuffle_partitions, table
from .word_cache import by_space

MAGIC, VERSION = b"VXTF", 1
HEAD, TAIL = struct.Struct("<4sHH32s"), struct.Struct("<QQ4s")
SAMPLE, SAMPLE_BYTES, DICT_BYTES, LEVEL = 1000, 64_000, 112_640, 3
#: A file ends after the document with which it passes this many bytes.
FILE_BYTES = 256_000_000
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


class Writer:
    """Writes one file to a binary sink."""

    def __init__(self, sink, dictionary: bytes, width: int):
        self.sink, self.width, self.at = sink, width, HEAD.size
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=False)
        self.offsets, self.counts, self.doc_ids = [self.at], [], []
        sink.write(HEAD.pack(MAGIC, VERSION, width, hashlib.sha256(dictionary).digest()))

    def add(self, doc_id: int | None, serialized: bytes) -> None:
        frame = self.zip.compress(serialized)
        self.sink.write(frame)
        self.at += len(frame)
        self.offsets.append(self.at)
        self.counts.append(len(serialized) // self.width)
        self.doc_ids.append(doc_id)

    def close(self) -> None:
        self.sink.write(np.array(self.offsets, "<u8").tobytes() + np.array(self.counts, "<u4").tobytes())
        self.sink.write(np.array([x or 0 for x in self.doc_ids], "<i8").tobytes() + np.array([x is None for x in self.doc_ids], "u1").tobytes())
        self.sink.write(TAIL.pack(self.at, len(self.counts), MAGIC))
        self.sink.close()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source, dictionary: bytes):
        self.source = source
        size = source.size()
        source.seek(0)
        magic, version, self.width, digest = HEAD.unpack(source.read(HEAD.size))
        source.seek(size - TAIL.size)
        at, n, tail = TAIL.unpack(source.read(TAIL.size))
        if (magic, tail, version) != (MAGIC, MAGIC, VERSION):
            raise ValueError("not a token-id file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        source.seek(at)
        self.offsets = np.frombuffer(source.read(8 * (n + 1)), "<u8").astype(np.int64)
        self.counts = np.frombuffer(source.read(4 * n), "<u4").astype(np.int64)
        self.doc_ids = np.frombuffer(source.read(8 * n), "<i8")
        self.nulls = np.frombuffer(source.read(n), "u1").astype(bool)
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.counts)

    def read(self, i: int) -> np.ndarray:
        """The ids of document i."""
        self.source.seek(int(self.offsets[i]))
        return self._ids(self.source.read(int(self.offsets[i + 1] - self.offsets[i])), i)

    def __iter__(self) -> Iterator[np.ndarray]:
        for i in range(len(self)):
            yield self.read(i)

    def _ids(self, frame: bytes, i: int) -> np.ndarray:
        raw = self.unzip.decompress(frame, max_output_size=max(1, int(self.counts[i]) * self.width))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = open_fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


_ENCODERS: dict[str, object] = {}


def encoder(tokenizer_file: str):
    """The encoder of this worker process for a tokenizers-library file."""
    if tokenizer_file not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor already use its cores
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_file)
        _ENCODERS[tokenizer_file] = (by_space(t, width_type(t.get_vocab_size())), np.dtype(width_type(t.get_vocab_size())))
    return _ENCODERS[tokenizer_file]


def width_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def train_dictionary(samples: list[bytes]) -> bytes:
    """Empty where there is too little to train on."""
    if sum(map(len, samples)) < 20 * 1024 or len(samples) < 20:
        return b""
    size = min(DICT_BYTES, sum(map(len, samples)) // 10)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write all documents; the manifest of files, which is the only way to them."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cache, dtype = encoder(tokenizer_file)
    end = np.array([end_id], dtype).tobytes()
    dictionary = train_dictionary([x + end for x in cache.encode(sample_texts(rows, "id", "text", SAMPLE, SAMPLE_BYTES))])
    name = f"{folder}/{hashlib.sha256(dictionary).hexdigest()}.zdict"
    write_bytes(name, dictionary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, done, writer, path, fs = TaskContext.get().partitionId(), 0, [], None, "", None
        shared, (own, kind) = read_bytes(name), encoder(tokenizer_file)
        for batch in batches:
            texts, names = batch.column("text"), batch.column("id").to_pylist()
            for i in range(0, len(texts), 256):
                for at, ids in enumerate(own.encode(texts[i : i + 256].to_pylist()), i):
                    if writer is None:
                        path = f"{folder}/part-{part:06d}-{seq:03d}-{uuid.uuid4().hex}.vxtf"
                        fs, local = open_fs(path)
                        writer = Writer(fs.open_output_stream(local, buffer_size=1 << 20), shared, kind.itemsize)
                    writer.add(names[at], ids + end)
                    if writer.at > FILE_BYTES:
                        writer.close()
                        done.append((part, seq, path, len(writer.counts), sum(writer.counts)))
                        writer, seq = None, seq + 1
        if writer is not None:
            writer.close()
            done.append((part, seq, path, len(writer.counts), sum(writer.counts)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "seq", "path", "n_docs", "n_ids"])

    ordered = rows.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    return materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest").withColumn("dictionary", F.lit(name))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (over its ids as u32), all read from the files."""
    spark = manifest.sparkSession
    ship(spark)
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, local = open_fs(r["path"])
                with fs.open_input_file(local) as f:
                    reader = Reader(Buffered(f), read_bytes(r["dictionary"]))
                    n = reader.counts
                    crc = [zlib.crc32(ids.tobytes()) for ids in reader]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids, pa.int64(), mask=reader.nulls), pa.array(np.cumsum(n) - n + r["start"], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.repartition(max(1, shuffle_partitions(spark)), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


class Buffered:
    """Sequential reads of small frames from large ones."""

    def __init__(self, source, chunk: int = 4 << 20):
        self.source, self.chunk, self.total, self.at, self.have, self.base = source, chunk, source.size(), 0, b"", 0

    def size(self) -> int:
        return self.total

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        if not (self.base <= self.at and self.at + n <= self.base + len(self.have)):
            self.source.seek(self.at)
            self.have, self.base = self.source.read(max(n, self.chunk)), self.at
        got = self.have[self.at - self.base : self.at - self.base + n]
        self.at += len(got)
        return got


def op9_token_id_files(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    """Writes documents as token files with end id 2 and returns what the files hold."""
    import public_tokenizers

    folder = scratch(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_token_files(write_token_files(docs, folder, tokenizer_file or public_tokenizers.path("word_bpe_49k.json"), 2))
