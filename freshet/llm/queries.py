"""The named queries of this subpackage, each with its SQL where there is one."""

from __future__ import annotations

import corpus_pipeline
from freshet.catalog.registry import Query
from freshet.llm import (
    decontamination, exact_topk, merkle, mixing, near_dedup, packing, pii, quality, repair, repeats, revisits, sharding,
    token_rollups,
)

QUERIES = {
    "op1_factorisation_machine": Query(quality.op1_factorisation_machine),
    "op2_low_discrepancy_mix": Query(mixing.op2_low_discrepancy_mix, mixing.SQL),
    "op8_odd_sketches": Query(near_dedup.op8_odd_sketches),
    "op3_vector_approximation_file": Query(exact_topk.op3_vector_approximation_file, exact_topk.SQL),
    "op4_candidate_boosting": Query(pii.op4_candidate_boosting),
    "op5_not_modified_revisits": Query(revisits.op5_not_modified_revisits, revisits.SQL),
    "op6_delta_rollups": Query(token_rollups.op6_delta_rollups, token_rollups.SQL),
    "op7_hash_tree_shards": Query(sharding.op7_hash_tree_shards, sharding.SQL),
    "op9_pigeonhole_edit_matching": Query(decontamination.op9_pigeonhole_edit_matching),
    "op10_depth_limited_radix_sort": Query(repeats.op10_depth_limited_radix_sort),
    "op11_auction_repair": Query(repair.op11_auction_repair),
    "op12_linear_grouping_packing": Query(packing.op12_linear_grouping_packing),
    "op13_butterfly_manifest": Query(merkle.op13_butterfly_manifest),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
