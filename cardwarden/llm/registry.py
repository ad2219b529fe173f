"""Registered queries of the package and the SQL of those that SQL can express."""

from __future__ import annotations

from cardwarden.llm import (
    language_id,
    masked_lm,
    mixing,
    packing,
    quality_ledger,
    simhash,
    source_divergence,
    suffix_dedup,
    superminhash,
    target_sampling,
    token_store,
    top_k,
    url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_language_id": language_id.op2_language_id,
    "op3_mixing": mixing.op3_mixing,
    "op4_packing": packing.op4_packing,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_masked_lm": masked_lm.op6_masked_lm,
    "op7_token_store": token_store.op7_token_store,
    "op8_simhash": simhash.op8_simhash,
    "op9_top_k": top_k.op9_top_k,
    "op10_quality_rules": quality_ledger.op10_quality_rules,
    "op11_superminhash": superminhash.op11_superminhash,
    "op12_target_sampling": target_sampling.op12_target_sampling,
    "op13_source_divergence": source_divergence.op13_source_divergence,
}

ORACLES = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op10_quality_rules": quality_ledger.OP10_SQL,
    "op11_superminhash": superminhash.OP11_SQL,
    "op12_target_sampling": target_sampling.OP12_SQL,
    "op13_source_divergence": source_divergence.OP13_SQL,
}
