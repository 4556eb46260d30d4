"""The registered queries of this subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from . import centroids, main_text, media, mixing, near_dup, packing, pieces, quality, repeats, secrets, spelling, token_counts, toxicity

QUERIES = {
    "op1_minhash_near_dedup": near_dup.op1_query,
    "op2_media_columns": media.op2_query,
    "op3_counterfactual_toxicity": toxicity.op3_query,
    "op4_poisson_mixing": mixing.op4_query,
    "op5_suffix_repeats": repeats.op5_query,
    "op6_secret_forest": secrets.op6_query,
    "op7_main_text": main_text.op7_query,
    "op8_token_ledger": token_counts.op8_query,
    "op9_merge_dropout": pieces.op9_query,
    "op10_quality_rules": quality.op10_query,
    "op11_spelling_variants": spelling.op11_query,
    "op12_harmonic_packing": packing.op12_query,
    "op13_centroid_clusters": centroids.op13_query,
}

ORACLES: dict[str, str] = {
    "op4_poisson_mixing": mixing.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_centroid_clusters": centroids.ORACLE,
}
