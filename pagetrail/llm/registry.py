"""The text operators' queries and their SQL."""

from __future__ import annotations

from . import (
    audit,
    fingerprints,
    html,
    lines,
    manifest,
    nearest,
    neardup,
    packing,
    pieces,
    quality,
    rules,
    sharding,
    substrings,
)

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_scaled_sketch": fingerprints.op3_scaled_sketch,
    "op4_sampled_pieces": pieces.op4_sampled_pieces,
    "op5_html_text": html.op5_html_text,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_stratified_sharding": sharding.op8_stratified_sharding,
    "op9_quality_rules": rules.op9_quality_rules,
    "op10_minhash_near_dedup": neardup.op10_minhash_near_dedup,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_ball_tree_top_k": nearest.op13_ball_tree_top_k,
}

ORACLES = {
    "op6_substring_dedup": substrings.SQL,
    "op7_line_dedup": lines.SQL,
    "op8_stratified_sharding": sharding.SQL,
    "op9_quality_rules": rules.SQL,
    "op10_minhash_near_dedup": neardup.SQL,
    "op11_merkle_manifest": manifest.SQL,
    "op12_filter_audit": audit.SQL,
    "op13_ball_tree_top_k": nearest.SQL,
}
