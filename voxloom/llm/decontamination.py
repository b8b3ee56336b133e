"""Benchmark decontamination: a broadcast hash set of test n-grams against the word windows of every text.

Words: A-Z lower-cased, maximal runs of characters that are not ASCII punctuation, white space or controls.
A benchmark item gives its windows of ``n`` consecutive words; an item of fewer words, but not none, is one
window. A word of a document is hit if it stands inside any occurrence of a window.

Hashes only propose; a hit counts after its words are compared as bytes.

Cases: null or empty texts and texts without words have no words and no hits; null items and items without
words have no windows; items with a null id are ignored; repeated rows and repeated ids are judged row by
row; an empty benchmark leaves all documents clean. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import as_row, materialise, named, part_of, row_schema, ship, table

#: Benchmark bytes in one broadcast; a larger benchmark is scanned in several passes.
BLOCK_LIMIT = 64_000_000
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


class Index:
    """Windows of benchmark items: a bitmap and sorted hashes to propose, word tuples to verify."""

    BITS = 22

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.by_length: dict[int, dict[int, dict[tuple, set]]] = {}
        grams = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        texts = pa.array([t for _, t in items], pa.string())
        for row, _, block in bw.blocks(texts, bw.non_alnum_table()):
            for d in range(len(block.first) - 1):
                a, b = int(block.first[d]), int(block.first[d + 1])
                k = min(n, b - a)
                for i, h in enumerate(bw.windows(block.hashes[a:b], k).tolist() if k else ()):
                    grams[k][h][tuple(block.word(j) for j in range(a + i, a + i + k))].add(items[row + d][0])
        for k, found in grams.items():
            hashes = np.array(sorted(found), bw.U)
            bitmap = np.zeros(1 << self.BITS, bool)
            bitmap[hashes >> bw.U(64 - self.BITS)] = True
            self.by_length[k] = (hashes, bitmap, {h: dict(w) for h, w in found.items()})

    def hits(self, block: bw.Block) -> Iterator[tuple[int, int, set]]:
        """(first word, number of words, items) of every verified occurrence."""
        for k, (hashes, bitmap, words) in self.by_length.items():
            got = bw.windows(block.hashes, k)
            maybe = np.flatnonzero(bitmap[got >> bw.U(64 - self.BITS)])
            at = np.minimum(np.searchsorted(hashes, got[maybe]), len(hashes) - 1)
            maybe = maybe[hashes[at] == got[maybe]]
            doc = np.searchsorted(block.first, maybe, "right") - 1
            maybe = maybe[maybe + k <= block.first[doc + 1]]
            for i in maybe.tolist():
                if items := words[int(got[i])].get(tuple(block.word(j) for j in range(i, i + k))):
                    yield i, k, items


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, *, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``row`` (all columns of docs), n_words, n_hit, items (ids as strings, sorted) and hit spans (UTF-8 byte offsets, merged)."""
    spark = docs.sparkSession
    ship(spark)
    bench = benchmark.select(named(item).cast("string").alias("id"), named(item_text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    size = bench.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    passes = 1 + int(size // BLOCK_LIMIT)
    place = docs.columns.index(text)
    out = docs.select(as_row(docs), F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    for p in range(passes):
        part = bench.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).collect()  # at most about BLOCK_LIMIT bytes
        index = spark.sparkContext.broadcast(Index([(r.id, r.text) for r in part], n))
        out = out.mapInArrow(_scanner(index, place), row_schema(docs, FOUND))
        if p < passes - 1:
            out = materialise(out, "decontamination").drop("n_words", "n_hit")
    return out


def _scanner(index, place: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = index.value
        for batch in batches:
            texts = part_of(batch, place)
            n_words, n_hit, items, spans = scan_texts(texts, table_)
            before_items, before_spans = batch.column("items").to_pylist(), batch.column("spans").to_pylist()
            for i in range(len(n_words)):
                if before_spans[i]:
                    items[i] = sorted({*items[i], *before_items[i]})
                    spans[i], n_hit[i] = merge(texts[i].as_py(), [*spans[i], *((s["start"], s["end"]) for s in before_spans[i])])
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            cols = [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span_type)]
            yield pa.RecordBatch.from_arrays(cols, ["row", "n_words", "n_hit", "items", "spans"])

    return run


def scan_texts(texts: pa.Array, index: Index) -> tuple[list, list, list, list]:
    """n_words, n_hit, sorted items and merged byte spans of each text."""
    n_words, n_hit, items, spans = [], [], [], []
    for row, end, block in bw.blocks(texts, bw.non_alnum_table()):
        n = len(block.hashes)
        step = np.zeros(n + 1, np.int64)
        of = defaultdict(set)
        for i, k, found in index.hits(block):
            step[i] += 1
            step[i + k] -= 1
            of[int(np.searchsorted(block.first, i, "right")) - 1] |= found
        hit = np.cumsum(step[:n]) > 0
        sums = np.concatenate([[0], np.cumsum(hit)])
        n_words += np.diff(block.first).tolist()
        n_hit += (sums[block.first[1:]] - sums[block.first[:-1]]).tolist()
        for d in range(end - row):
            items.append(sorted(of.get(d, ())))
            if d not in of:
                spans.append([])
                continue
            a, b = int(block.first[d]), int(block.first[d + 1])
            on = np.flatnonzero(hit[a:b]) + a
            cuts = np.flatnonzero(np.diff(on) > 1)
            begin, stop = on[np.concatenate([[0], cuts + 1])], on[np.concatenate([cuts, [len(on) - 1]])]
            base = int(block.text_at[d])
            spans.append([(int(block.starts[s]) - base, int(block.ends[e]) - base) for s, e in zip(begin.tolist(), stop.tolist(), strict=True)])
    return n_words, n_hit, items, spans


def merge(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """Spans of several passes as one list, and the number of words inside."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    raw = text.encode()
    inside = [raw[a:b].decode() for a, b in out]
    words = sum(len(b.hashes) for _, _, b in bw.blocks(pa.array(inside), bw.non_alnum_table()))
    return out, words


def cut_spans(text: str | None, spans) -> str | None:
    """The text without its spans."""
    if text is None or spans is None or len(spans) == 0:
        return text
    raw, at, out = text.encode(), 0, []
    for s in spans:
        out.append(raw[at : s["start"]])
        at = s["end"]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, mode: str = "documents") -> DataFrame:
    """The columns of docs; contaminated documents go (``documents``) or lose their hit spans (``spans``)."""
    found = scan(docs, benchmark, n)
    if mode == "documents":
        return found.where("n_hit = 0").select("row.*")
    if mode != "spans":
        raise ValueError("mode is documents or spans")
    cut = F.pandas_udf(lambda t, s: _cut_series(t, s), "string")
    columns = [cut(F.col("row.text"), F.col("spans")).alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    out = found.select(*columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _cut_series(texts, spans):
    import pandas as pd

    return pd.Series([cut_spans(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), 10)
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM b)),
ks AS (SELECT DISTINCT k FROM g),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
h AS (SELECT doc_id, k, i, item_id FROM dw JOIN g USING (k, g)),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
