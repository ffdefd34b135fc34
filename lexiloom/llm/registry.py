"""The queries opN_<name> of this folder and the SQL they are held against."""

from __future__ import annotations

from lexiloom.llm import ann, compression_quality, html_extract, line_dedup, mixing, near_dups, packing, pii, quality_rules, substring_dedup

QUERIES = {
    "op1_html_extract": html_extract.query,
    "op2_suffix_dedup": substring_dedup.query,
    "op3_minhash_near_dups": near_dups.query,
    "op4_best_fit_packing": packing.query,
    "op5_compression_quality": compression_quality.query,
    "op6_nearest_vectors": ann.query,
    "op7_line_dedup": line_dedup.query,
    "op8_personal_data": pii.query,
    "op9_source_mixing": mixing.query,
    "op10_quality_rules": quality_rules.query,
}
ORACLES = {"op2_suffix_dedup": substring_dedup.ORACLE, "op3_minhash_near_dups": near_dups.ORACLE, "op10_quality_rules": quality_rules.ORACLE}
