"""The registered queries of the language-model operators, and their SQL."""

from __future__ import annotations

from emberlog.llm import (
    decontaminate, language_id, lexical_search, packing, quality_classifier, quality_rules, resampling, sharding, simhash_dedup, substring_dedup,
    suffix_dedup, toxicity, warc)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_suffix_array_dedup": suffix_dedup.op2_suffix_array_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_language_id": language_id.op5_language_id,
    "op6_warc": warc.op6_warc,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_sharding": sharding.op8_sharding,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_simhash_near_dedup": simhash_dedup.op10_simhash_near_dedup,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_importance_resampling": resampling.op12_importance_resampling,
    "op13_ranked_search": lexical_search.op13_ranked_search,
}

ORACLE = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op2_suffix_array_dedup": suffix_dedup.ORACLE,
    "op4_benchmark_decontamination": decontaminate.ORACLE,
    "op6_warc": warc.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op12_importance_resampling": resampling.ORACLE,
    "op13_ranked_search": lexical_search.ORACLE,
}
