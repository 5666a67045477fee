"""The queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from tripflow.llm import chat, exact_dedup, fingerprints, language, lexical, line_dedup, mixing, near_duplicates, repair, sentencepiece, sharding, suffix_tree, token_files

QUERIES = {
    "op1_sentencepiece": sentencepiece.op1_sentencepiece,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_token_files": token_files.op4_token_files,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_near_duplicates": near_duplicates.op7_near_duplicates,
    "op8_sharding": sharding.op8_sharding,
    "op9_language_id": language.op9_language_id,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_lm_scores": suffix_tree.op12_lm_scores,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op11_lexical_search": lexical.SQL,
}
