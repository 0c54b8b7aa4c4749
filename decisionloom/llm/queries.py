"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from decisionloom.llm import alignment, context_trees, hnsw, infilling, licences, minhash, mixing, nndescent, packing, quality, substrings, token_counts, toxicity

QUERIES = {
    "op1_nn_descent": nndescent.op1_nn_descent,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_packing": packing.op4_packing,
    "op5_licence_scan": licences.op5_licence_scan,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_hnsw_neighbours": hnsw.op7_hnsw_neighbours,
    "op8_minhash_neardup": minhash.op8_minhash_neardup,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_fill_in_middle": infilling.op11_fill_in_middle,
    "op12_tokenizer_alignment": alignment.op12_tokenizer_alignment,
    "op13_context_trees": context_trees.op13_context_trees,
}

ORACLE_SQL = {
    "op9_mixing": mixing.OP9_SQL,
    "op11_fill_in_middle": infilling.OP11_SQL,
}
