"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ann, chat, decontaminate, jaccard_join, langid, mixing, pii, quality, substring_dedup, suffix_dedup

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op1_substring_dedup_all_lines": substring_dedup.query_all_lines,
    "op2_ngram_jaccard_join": jaccard_join.query,
    "op3_nearest_neighbours": ann.query,
    "op4_suffix_array_dedup": suffix_dedup.query,
    "op5_benchmark_decontamination": decontaminate.query,
    "op6_pii": pii.query,
    "op7_quality_classifier": quality.query,
    "op8_language_id": langid.query,
    "op9_chat_formatting": chat.query,
    "op9_chat_tool_calls": chat.query_tool_calls,
    "op10_mixing_sources": mixing.query,
}

ORACLES = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op1_substring_dedup_all_lines": substring_dedup.SQL_ALL_LINES,
    "op2_ngram_jaccard_join": jaccard_join.SQL,
    "op4_suffix_array_dedup": suffix_dedup.SQL,
    "op9_chat_formatting": chat.SQL,
    "op9_chat_tool_calls": chat.SQL_TOOL_CALLS,
    "op10_mixing_sources": mixing.SQL,
}
