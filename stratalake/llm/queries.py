"""Registered queries of this subpackage and the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from stratalake.llm import chat, decontamination, fingerprints, hard_negatives, markov, mixing, pii, quality, secret_scan, simhash, spelling, token_counts, toxicity

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_personal_data": pii.op3_personal_data,
    "op4_mixing": mixing.op4_mixing,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_document_fingerprints": fingerprints.op7_document_fingerprints,
    "op8_benchmark_decontamination": decontamination.op8_benchmark_decontamination,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_language_model": markov.op13_language_model,
}
ORACLES: dict[str, str] = {
    "op8_benchmark_decontamination": decontamination.ORACLE,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
