"""Queries op1 to op10 over the driver's tables, and their SQL."""

from __future__ import annotations

from quire.llm import bpe, context_mixing, embedding_dedup, line_dedup, mixing, quality, simhash, substring_dedup, topk, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_query,
    "op2_exact_top_k": topk.op2_query,
    "op3_toxicity": toxicity.op3_query,
    "op4_quality_classifier": quality.op4_query,
    "op5_lm_scoring": context_mixing.op5_query,
    "op6_embedding_near_dedup": embedding_dedup.op6_query,
    "op7_substring_dedup": substring_dedup.op7_query,
    "op8_bpe": bpe.op8_query,
    "op9_simhash_near_dedup": simhash.op9_query,
    "op10_mixing_sources": mixing.op10_query,
}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_exact_top_k": topk.OP2_SQL,
    "op6_embedding_near_dedup": embedding_dedup.OP6_SQL,
    "op7_substring_dedup": substring_dedup.OP7_SQL,
    "op10_mixing_sources": mixing.OP10_SQL,
}
