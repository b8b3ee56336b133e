"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of ``char_lm``, learned from all training texts. The language with the lowest
cross-entropy per character wins (the first in order of names on a tie). A text is rejected if even that is
further above the language's usual cross-entropy, measured in spreads that shrink with length, than ``SAFETY``
times what ``QUANTILE`` of the calibration texts show. The calibration texts are all training rows: each is scored by
models of the half of the texts that it isn't in (copies fall into one half), so that a small language, whose model
knows its own texts by heart, is measured as on new ones. A language with fewer than ``ENOUGH`` such texts has no usual
cross-entropy, and no text is rejected against it.

Cases: null texts and texts without letters are ``und`` with score 0 and rejected; without training rows
everything is ``und``; rows with a null language or id aren't learned from; repeated rows are predicted alike;
other columns pass through whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .char_lm import Models, count_grams, fit
from .common import as_row, discard, materialise, named, part_of, row_schema, ship, table

ENOUGH, QUANTILE, SAFETY = 10, 0.999, 3.0
#: Cross-entropy that any text may differ by, as a share of the language's own.
MARGIN = 0.1


@dataclass
class Identifier:
    models: Models
    mean: np.ndarray
    spread: np.ndarray
    limit: float

    def predict(self, texts: list[str | None]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """language, score, cross-entropy and whether it is rejected."""
        sums, n = self.models.totals([t or "" for t in texts])
        if not self.models.labels:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        size = np.maximum(n, 1)
        entropy = -sums / size[:, None]
        best = entropy.argmin(1)
        rows = np.arange(len(texts))
        low = entropy[rows, best]
        # odds per character, over at most 50 of them: a long text isn't surer than its margin
        score = 1 / np.exp2(-(entropy - low[:, None]) * np.minimum(size, 50)[:, None]).sum(1)
        none = n == 0
        rejected = none | (self.excess(low, best, size) > self.limit)
        return ["und" if x else self.models.labels[b] for x, b in zip(none, best, strict=True)], np.where(none, 0, score), np.where(none, 0, low), rejected

    def excess(self, entropy: np.ndarray, label: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Distance above the usual cross-entropy, in spreads; none where that isn't known (nan)."""
        mean = self.mean[label]
        return np.where(np.isnan(mean), -np.inf, (entropy - mean) / (self.spread[label] / np.sqrt(size) + MARGIN * mean))


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Identifier:
    """Learns from all rows given."""
    half = F.when(F.xxhash64("text") % 2 == 0, "0").otherwise("1")
    rows = docs.select(named(lang).cast("string").alias("lang"), named(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL").withColumn("half", half)
    found = count_grams(rows.select(F.concat("half", "lang").alias("label"), "text"), "label", "text")
    counts = materialise(found.select(F.substring("label", 1, 1).alias("half"), F.expr("substring(label, 2)").alias("label"), "gram", "n"), "half-grams")
    models = fit(counts.groupBy("label", "gram").agg(F.sum("n").alias("n")))
    others = {h: fit(counts.where(F.col("half") != h).select("label", "gram", "n")) for h in "01"}
    seen = materialise(_entropies(rows, others), "entropies")
    mean, spread = np.full(len(models.labels), np.nan), np.full(len(models.labels), np.nan)
    size, each = F.col("size"), F.col("entropy")
    sums = seen.where("entropy IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), F.sum(size).alias("n"), F.sum(each * size).alias("e"), F.sum(each * each * size).alias("ee"))
    for r in sums.where(F.col("texts") >= ENOUGH).collect():
        j = models.labels.index(r.lang)
        mean[j] = r.e / r.n
        spread[j] = np.sqrt(max(0.0, r.ee - r.e * r.e / r.n) / r.texts)
    out = Identifier(models, mean, spread, np.inf)
    usual = [(name, float(m), float(s)) for name, m, s in zip(models.labels, mean, spread, strict=True) if not np.isnan(m)]
    if usual:
        known = F.broadcast(docs.sparkSession.createDataFrame(usual, "best string, mean double, spread double"))
        excess = (F.col("low") - F.col("mean")) / (F.col("spread") / F.sqrt("size") + MARGIN * F.col("mean"))
        out.limit = SAFETY * max(1.0, seen.join(known, "best").agg(F.percentile_approx(excess, QUANTILE, 100_000)).head()[0] or 0.0)
    discard(counts)
    discard(seen)
    return out


def _entropies(rows: DataFrame, others: dict[str, Models]) -> DataFrame:
    """lang, entropy under its own language (null where its half's model lacks that), best language, the entropy under it, size, of each text with letters."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(others)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = np.array(batch.column("half").to_pylist())
            for h, model in shared.value.items():
                part = batch.filter(pa.array(halves == h))
                if not part.num_rows or not model.labels:
                    continue
                sums, n = model.totals(part.column("text").to_pylist())
                at = {name: j for j, name in enumerate(model.labels)}
                langs = part.column("lang").to_pylist()
                own = np.array([at.get(x, -1) for x in langs])
                entropy = -sums / np.maximum(n, 1)[:, None]
                line, best = np.arange(len(n)), entropy.argmin(1)
                use = pa.array(n > 0)
                columns = [part.column("lang"), pa.array(entropy[line, own], mask=own < 0), pa.array([model.labels[b] for b in best], pa.string()), pa.array(entropy[line, best]), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "entropy", "best", "low", "size"]).filter(use)

    return rows.select("lang", "text", "half").mapInArrow(run, "lang string, entropy double, best string, low double, size long")


def identify(docs: DataFrame, identifier: Identifier, text: str = "text") -> DataFrame:
    """``row`` (all columns of docs), lang_pred, score, cross_entropy, rejected."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(identifier)
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang, score, entropy, rejected = model.predict(part_of(batch, place).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())], ["row", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(as_row(docs)).mapInArrow(run, row_schema(docs, "lang_pred string, score double, cross_entropy double, rejected boolean"))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    identifier = train(docs.where(fold("doc_id", 4) != 2))
    out = identify(docs.select("doc_id", "text"), identifier)
    return out.select("row.doc_id", F.coalesce(fold("row.doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
