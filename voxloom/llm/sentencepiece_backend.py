"""SentencePiece models on the tokenizers library.

The model file's protobuf is parsed here; from it come the normaliser (precompiled map, white-space rules,
dummy prefix), the metaspace marker, the scores (unigram log-probabilities, or merge order for BPE models)
and byte fallback. Control and unknown pieces never match text, user-defined ones always do.

A piece with the marker inside doesn't exist in models that split at white space. The ids of a text are then
those of its parts cut before each run of markers, so a worker keeps the ids of parts it has seen, and sends
the new ones to the library in multithreaded batches. Every new part is checked: its ids against those of the
SentencePiece library, its decoding against itself. Models that can't be cut get whole texts as parts; ids of models
that remove spaces, add none in front or map characters are compared by whole texts, without the decoding.

Cases: null text stays null in encoded and decoded columns with 0 ids; empty text has no ids; repeated rows
are encoded alike; other columns pass through whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_row, held, part_of, row_schema, ship, table
from .word_cache import PieceCache

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Threads of the library in one task.
THREADS = 2
#: Parts that a worker keeps: its process lives on in the stages that follow.
KEEP = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message; integers, 4- and 8-byte words as bytes, strings as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} in a SentencePiece model")
        yield key >> 3, value


@dataclass
class Model:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True
    suffix_spaces: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = {k: v for k, v in _fields(value)}
                m.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                m.kind, m.byte_fallback, m.suffix_spaces = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), bool(spec.get(24, 0))
            elif number == 3:
                spec = dict(_fields(value))
                m.charsmap = spec.get(2, b"")
                m.dummy_prefix, m.remove_extra_spaces, m.escape_spaces = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        return m


class Backend:
    """A tokenizers-library twin of a SentencePiece model."""

    def __init__(self, data: bytes):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        m = self.model = Model.parse(data)
        if m.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be rebuilt")
        if m.suffix_spaces or not m.escape_spaces:
            raise ValueError("models with white space as suffix or unescaped aren't rebuilt")
        unknown = next(i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN)
        vocabulary = {p[0]: i for i, p in enumerate(m.pieces)}
        if m.kind == UNIGRAM:
            self.tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], unknown, m.byte_fallback))
        else:
            self.tokenizer = Tokenizer(models.BPE(vocabulary, self.merges(m), unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback))
        if user := [AddedToken(p, normalized=False) for p, _, kind in m.pieces if kind == USER_DEFINED]:
            self.tokenizer.add_tokens(user)
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.remove_extra_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if m.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        self.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.shown = [_shown(p, kind) for p, _, kind in m.pieces]
        self.cuttable = not user and not any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind == NORMAL)
        self.dtype = np.dtype("<u2" if len(m.pieces) <= 1 << 16 else "<u4")

    @staticmethod
    def merges(m: Model) -> list[tuple[str, str]]:
        """Every way to put a piece together from two, best score first."""
        score = {p: s for p, s, kind in m.pieces if kind == NORMAL}
        rank = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        found = [(-score[p], rank[p], i, p) for p in score for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
        return [(p[:i], p[i:]) for _, _, i, p in sorted(found)]

    def normalize(self, text: str) -> str:
        return self.normalizer.normalize_str(text)

    def restore(self, text: str) -> str:
        """Decoded text without the dummy prefix."""
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall


class Worker:
    """Encoder of one worker process: cached parts with their ids, each checked when it is new."""

    def __init__(self, data: bytes):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        import sentencepiece

        self.backend = Backend(data)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.odd: set[str] = set()
        #: Whether the library can be asked part by part: it must leave a part's spaces alone and add one in front.
        self.by_part = self.backend.cuttable and self.backend.model.dummy_prefix and not self.backend.model.remove_extra_spaces and not self.backend.model.charsmap
        self.cache = PieceCache(_CUT if self.backend.cuttable else lambda t: [t], self.encode_new, KEEP)

    def encode_new(self, parts: list[str]) -> list[bytes]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        t, out = self.backend.tokenizer, []
        for i in range(0, len(parts), 4096):
            some = parts[i : i + 4096]
            ids = [x.ids for x in t.encode_batch_fast(some, add_special_tokens=False)]
            # the library adds the prefix that stands at the front of a part, or one to take away again
            marked = [self.by_part and p.startswith(MARK) for p in some]
            theirs = self.library.encode([p[1:].replace(MARK, " ") if k else "" for p, k in zip(some, marked, strict=True)], num_threads=THREADS)
            back = t.decode_batch(ids, skip_special_tokens=False)
            for p, own, k, their, text in zip(some, ids, marked, theirs, back, strict=True):
                if (k and len(p) > 1 and own != their) or text != p.replace(MARK, " "):
                    self.odd.add(p)
                out.append(np.array(own, self.backend.dtype).tobytes())
        return out


    def parity(self, texts: list[str], normal: list[str], ids: list[bytes]) -> list[bool]:
        """Whether ids are those of the SentencePiece library: by parts where that can be, else by whole texts."""
        if self.by_part:
            return [not self.odd or self.odd.isdisjoint(self.cache.cut(n)) for n in normal]
        theirs = self.library.encode(texts, num_threads=THREADS)
        own = (np.frombuffer(x, self.backend.dtype).tolist() for x in ids)
        return [a == b for a, b in zip(own, theirs, strict=True)]


def worker(data: bytes) -> Worker:
    return held(("sentencepiece", zlib.crc32(data) << 32 | len(data)), lambda: Worker(data))


def encode(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """``row`` (all columns of docs), token_ids (little-endian binary), n_tokens, decoded, parity.

    decoded: the text that the ids stand for. parity: false where ids differ from the SentencePiece library's or, by
    parts, the decoding from the part.
    """
    spark = docs.sparkSession
    ship(spark)
    data = spark.sparkContext.broadcast(open(model_file, "rb").read())
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = worker(data.value)
        b = w.backend
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part_of(part, place).to_pylist()
                normal = [b.normalize(t or "") for t in texts]
                ids = w.cache.encode(normal)
                parity = w.parity([t or "" for t in texts], normal, ids)
                decoded = decode_texts(b, ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([None if t is None else x for t, x in zip(texts, ids, strict=True)], pa.binary()),
                        pa.array([len(x) // b.dtype.itemsize for x in ids], pa.int64()),
                        pa.array([None if t is None else x for t, x in zip(texts, decoded, strict=True)], pa.string()),
                        pa.array(parity, pa.bool_()),
                    ],
                    ["row", "token_ids", "n_tokens", "decoded", "parity"],
                )

    return docs.select(as_row(docs)).mapInArrow(run, row_schema(docs, "token_ids binary, n_tokens long, decoded string, parity boolean"))


def decode_texts(backend: Backend, ids: list[bytes]) -> list[str]:
    """Texts of id arrays: pieces joined, runs of byte pieces read as UTF-8."""
    shown = backend.shown
    out = []
    for raw in ids:
        text = "".join(map(shown.__getitem__, np.frombuffer(raw, backend.dtype).tolist()))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        out.append(backend.restore(text))
    return out


def _shown(piece: str, kind: int) -> str:
    if kind == BYTE:
        b = int(piece[3:-1], 16)
        return chr(b) if b < 128 else chr(0xDC00 + b)
    return "" if kind == CONTROL else piece.replace(MARK, " ")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    """Per document: n_tokens, crc32 of its ids as u32, SHA-256 of the decoded text, whether that is the text, parity."""
    import public_tokenizers

    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model_file or public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "row.doc_id", "n_tokens", F.crc32(F.coalesce("token_ids", F.lit(b""))).alias("ids_crc32"), F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"), "parity",
    )
