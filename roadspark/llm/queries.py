"""Queries of this subpackage and the SQL that checks those SQL can express."""

from __future__ import annotations

from roadspark.llm import (
    bitsliced, bpe_automaton, caps, divergence, extraction, filter_audit, packing, pii, quality, repeats, sharding,
    simhash, spelling,
)

_RUN = (
    quality.op1_byte_cnn, bitsliced.op2_bit_sliced_top_k, extraction.op3_recurrent_blocks,
    caps.op4_spherical_caps, packing.op5_power_of_two_packing,
    simhash.op6_simhash_blocks, bpe_automaton.op7_tokenization_automaton, repeats.op8_suffix_array_dedup,
    sharding.op9_virtual_slots, pii.op10_candidate_boosting, divergence.op11_distribution_divergence,
    filter_audit.op12_filter_audit, spelling.op13_spelling_variants,
)
QUERIES = {run.__name__: run for run in _RUN}
ORACLE = {
    "op2_bit_sliced_top_k": bitsliced.OP2_SQL, "op4_spherical_caps": caps.OP4_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL, "op13_spelling_variants": spelling.OP13_SQL,
}
