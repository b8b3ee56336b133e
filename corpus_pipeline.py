"""Corpus preparation as a chain of stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. Stages, in order:

1. language ID: documents that the identifier rejects go (no letters, or text that no language's model explains)
2. toxicity: documents with a score of at least 0.5 go
3. n-gram Jaccard join (five words, similarity 0.8): of each group the document with the smallest id stays
4. benchmark decontamination: documents with any ten consecutive words of a benchmark item go
5. SentencePiece encoding and decoding: token ids, and whether decoding them gives the text back

Null texts have no letters and go in stage 1. Rows are judged one by one, whole texts whatever their length: repeated
rows share their fate, but for stage 3, which keeps all rows of the smallest id. Other columns of documents, whatever their
names, pass through all stages but the last. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import decontamination, language_id, ngram_jaccard, sentencepiece_backend, toxicity
from voxloom.llm.common import materialise, table


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the identifier accepts. It learns from the rows with a language, three quarters of them; where none has one, all documents are rejected."""
    identifier = language_id.train(docs.where(language_id.fold("doc_id", 4) != 2))
    return language_id.identify(docs, identifier).where("NOT rejected").select("row.*")


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under one half. Labels are learned from the rows that are not held out; without toxic ones, nothing goes."""
    model = toxicity.character_model(docs)
    labels = table(spark, sf_dir, "labels").where(language_id.fold("doc_id", 5) != 0)
    scorer = toxicity.train(docs, labels, model)
    return toxicity.score(docs, scorer, model).where("score < 0.5").select("row.*")


def stage_ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the rows with the smallest id. Rows with a null id or without words stay."""
    return ngram_jaccard.keep_one(docs, 5, 8, 10)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item (items of fewer words: all of them). Without items, all stay."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), 10, "documents")


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, token_ids (little-endian), round_trip (decoding gives the text) and parity (ids are the library's). Empty texts have no ids."""
    import public_tokenizers

    out = sentencepiece_backend.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    whole = F.col("decoded").eqNullSafe(F.col("row.text"))
    return out.select("row.doc_id", "row.lang", "row.source", "row.n_chars", "n_tokens", "token_ids", whole.alias("round_trip"), "parity")


STAGES = [
    ("language_id", stage_language_id),
    ("toxicity", stage_toxicity),
    ("ngram_jaccard", stage_ngram_jaccard),
    ("decontamination", stage_decontamination),
    ("sentencepiece", stage_sentencepiece),
]

#: The stages learn models, which SQL can't express; tests/llm hold the operators against brute force and the chain
#: against its stages' rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
