"""The corpus operators bound to the tables, and their SQL where SQL can express them."""

from __future__ import annotations

from . import (
    codec,
    hard_negatives,
    licenses,
    lm_scoring,
    packing,
    pii,
    quality_rules,
    simhash,
    square_packing,
    suffix_dedup,
    token_counts,
    weighted_fingerprints,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_bpe_codec": codec.op2_bpe_codec,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_simhash": simhash.op7_simhash,
    "op8_fingerprints": weighted_fingerprints.op8_fingerprints,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_personal_data": pii.op10_personal_data,
    "op11_square_packing": square_packing.op11_square_packing,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op6_quality_rules": quality_rules.OP6_SQL,
    "op9_license_scan": licenses.OP9_SQL,
    "op10_personal_data": pii.OP10_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
}
