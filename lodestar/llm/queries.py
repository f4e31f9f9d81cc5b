"""The queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import byte_bpe, collocations, host_rules, huffman_ids, license_scan, line_dedup, main_text, mixing, ppm, ranked_search, signature_tree, topk_products, toxicity

QUERIES = {
    "op1_classifier_chain": toxicity.op1_classifier_chain,
    "op2_huffman_ids": huffman_ids.op2_huffman_ids,
    "op3_signature_join": signature_tree.op3_signature_join,
    "op4_ppm_scores": ppm.op4_ppm_scores,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op7_systematic_mix": mixing.op7_systematic_mix,
    "op8_top_products": topk_products.op8_top_products,
    "op9_host_rules": host_rules.op9_host_rules,
    "op10_line_blocks": main_text.op10_line_blocks,
    "op11_block_max_search": ranked_search.op11_block_max_search,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE = {
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op7_systematic_mix": mixing.OP7_SQL,
    "op8_top_products": topk_products.OP8_SQL,
    "op9_host_rules": host_rules.OP9_SQL,
    "op11_block_max_search": ranked_search.OP11_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
