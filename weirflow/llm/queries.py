"""The queries of this subpackage, one for each operator, and the SQL they are held against."""

from __future__ import annotations

from . import chat, decontam, html, langid, neardup, packing, quality, search, secrets, tokens

QUERIES = {
    "op1_minhash_near_dedup": neardup.op1_minhash_near_dedup,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_html_main_text": html.op3_html_main_text,
    "op4_benchmark_decontamination": decontam.op4_benchmark_decontamination,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_exact_top_k": search.op6_exact_top_k,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_language_id": langid.op9_language_id,
    "op10_quality_classifier": quality.op10_quality_classifier,
}

#: Tokens need a vocabulary, trees and models a program: those have no SQL.
ORACLE_SQL = {
    "op1_minhash_near_dedup": neardup.ORACLE,
    "op4_benchmark_decontamination": decontam.ORACLE,
    "op6_exact_top_k": search.ORACLE,
    "op7_secret_scan": secrets.ORACLE,
    "op8_chat_formatting": chat.ORACLE,
}
