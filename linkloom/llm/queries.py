"""Queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import (
    decontamination, exact_dedup, extraction, language_id, mixing, near_dedup, passages, pii, prefix_trie, token_counts, toxicity, warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_passages": passages.op1_passages,
    "op2_warc": warc.op2_warc,
    "op3_mixing": mixing.op3_mixing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_extraction": extraction.op6_extraction,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_pii": pii.op8_pii,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_language_id": language_id.op10_language_id,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.OP3_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
}
