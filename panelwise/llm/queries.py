"""The registered queries of this package and their SQL."""

from __future__ import annotations

from . import context_tree, grid_codes, lexical, line_frequency, mixing, multi_index, pieces, quality, sharding, simhash, suffixes, token_counts, token_store

QUERIES = {
    "op1_context_tree": context_tree.op1_context_tree,
    "op2_token_store": token_store.op2_token_store,
    "op3_long_repeats": suffixes.op3_long_repeats,
    "op4_weighted_fair_mix": mixing.op4_weighted_fair_mix,
    "op5_simhash_duplicates": simhash.op5_simhash_duplicates,
    "op6_line_frequency": line_frequency.op6_line_frequency,
    "op7_embedding_duplicates": multi_index.op7_embedding_duplicates,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_quality_classifier": quality.op9_quality_classifier,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_grid_codes": grid_codes.op11_grid_codes,
    "op12_lexical_search": lexical.op12_lexical_search,
    "op13_jump_shards": sharding.op13_jump_shards,
}

SQL = {
    "op4_weighted_fair_mix": mixing.SQL,
    "op6_line_frequency": line_frequency.SQL,
    "op11_grid_codes": grid_codes.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_jump_shards": sharding.SQL,
}
