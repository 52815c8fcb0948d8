"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from odsflow.llm import alignment, clustering, decontamination, exact_search, license_templates, near_duplicates, quality_crf, quality_rules, sentencepieces, sharding, suffix_dedup, token_counts, tool_calls

QUERIES = {
    "op1_tool_calls": tool_calls.op1_tool_calls,
    "op10_fm_index": decontamination.op10_fm_index,
    "op11_norm_buckets": exact_search.op11_norm_buckets,
    "op12_subvector_dictionaries": clustering.op12_subvector_dictionaries,
    "op13_tokenizer_spans": alignment.op13_tokenizer_spans,
    "op2_license_templates": license_templates.op2_license_templates,
    "op3_line_crf": quality_crf.op3_line_crf,
    "op4_suffix_array": suffix_dedup.op4_suffix_array,
    "op5_sentencepiece": sentencepieces.op5_sentencepiece,
    "op6_adaptive_thresholds": quality_rules.op6_adaptive_thresholds,
    "op7_edit_aware_counts": token_counts.op7_edit_aware_counts,
    "op8_chosen_path": near_duplicates.op8_chosen_path,
    "op9_stratified_interleave": sharding.op9_stratified_interleave,
}

SQL = {
    "op10_fm_index": decontamination.SQL,
    "op11_norm_buckets": exact_search.SQL,
    "op12_subvector_dictionaries": clustering.SQL,
    "op2_license_templates": license_templates.SQL,
    "op6_adaptive_thresholds": quality_rules.SQL,
    "op9_stratified_interleave": sharding.SQL,
}
