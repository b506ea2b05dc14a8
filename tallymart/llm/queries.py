"""The registered queries of this subpackage and the SQL texts they are compared with."""

from __future__ import annotations

from tallymart.llm import (alignment, doubling, factorisation, hilbert_pack, kdtree, mixture, ngram_join, pii,
                           quality_rules, repair, suffix_arrays, toxicity, warc)

LLM_QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_factorisation_machine": factorisation.op2_factorisation_machine,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_doubling_dedup": doubling.op4_doubling_dedup,
    "op5_mix_sources": mixture.op5_mix_sources,
    "op6_hilbert_packing": hilbert_pack.op6_hilbert_packing,
    "op7_warc_index_merge": warc.op7_warc_index_merge,
    "op8_suffix_array_dedup": suffix_arrays.op8_suffix_array_dedup,
    "op9_disclosing_terms": pii.op9_disclosing_terms,
    "op10_kd_tree_top_k": kdtree.op10_kd_tree_top_k,
    "op11_toxicity_trees": toxicity.op11_toxicity_trees,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}

LLM_ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op4_doubling_dedup": doubling.ORACLE,
    "op7_warc_index_merge": warc.ORACLE,
    "op8_suffix_array_dedup": suffix_arrays.ORACLE,
    "op10_kd_tree_top_k": kdtree.ORACLE,
    "op12_conversation_repair": repair.ORACLE,
}
