"""The corpus queries and, where SQL can express them, their SQL twins."""

from . import bpe, extraction, licenses, merkle, mixing, neardup, periodic, repetition, spelling, substrings, tokencounts, tokenstore, toxicity

QUERIES = {
    "op1_toxicity_crf": toxicity.op1_toxicity_crf,
    "op2_source_mixing": mixing.op2_source_mixing,
    "op3_repetition_rules": repetition.op3_repetition_rules,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_suffix_dedup": substrings.op5_suffix_dedup,
    "op6_merkle_fingerprint": merkle.op6_merkle_fingerprint,
    "op7_token_counts": tokencounts.op7_token_counts,
    "op8_jaccard_forest": neardup.op8_jaccard_forest,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_token_store": tokenstore.op10_token_store,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_html_extraction": extraction.op13_html_extraction,
}
ORACLES = {
    "op2_source_mixing": mixing.OP2_SQL,
    "op3_repetition_rules": repetition.OP3_SQL,
    "op6_merkle_fingerprint": merkle.OP6_SQL,
    "op8_jaccard_forest": neardup.OP8_SQL,
    "op11_periodic_runs": periodic.OP11_SQL,
    "op12_spelling_variants": spelling.OP12_SQL,
    "op13_html_extraction": extraction.OP13_SQL,
}
