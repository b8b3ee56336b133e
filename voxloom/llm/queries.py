"""Queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from . import decontamination, language_id, ngram_jaccard, sentencepiece_backend, shard_tree, token_files, toxicity, url_filter, warc, weighted_fingerprint


def queries() -> dict:
    return {
        "op1_url_redirect_equivalence": url_filter.op1_url_redirect_equivalence,
        "op2_sharding_hash_tree": shard_tree.op2_sharding_hash_tree,
        "op3_sentencepiece": sentencepiece_backend.op3_sentencepiece,
        "op4_weighted_fingerprint": weighted_fingerprint.op4_weighted_fingerprint,
        "op5_warc_transactions": warc.op5_warc_transactions,
        "op6_language_id": language_id.op6_language_id,
        "op7_benchmark_decontamination": decontamination.op7_benchmark_decontamination,
        "op8_ngram_jaccard_join": ngram_jaccard.op8_ngram_jaccard_join,
        "op10_toxicity": toxicity.op10_toxicity,
        "op9_token_id_files": token_files.op9_token_id_files,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_redirect_equivalence": url_filter.OP1_SQL,
        "op5_warc_transactions": warc.OP5_SQL,
        "op7_benchmark_decontamination": decontamination.OP7_SQL,
        "op8_ngram_jaccard_join": ngram_jaccard.OP8_SQL,
    }
