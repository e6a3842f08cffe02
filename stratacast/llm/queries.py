"""Registered queries of the operators, and their SQL where SQL can express them."""

from stratacast.llm import (
    alignment,
    exact_dedup,
    jaccard_join,
    mixing,
    packing,
    periodic_runs,
    personal_data,
    revisits,
    secret_scan,
    sharding,
    substring_dedup,
    topk_search,
    toxicity,
)

QUERIES = {
    "op1_personal_data": personal_data.op1_personal_data,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_packing": packing.op3_packing,
    "op4_topk_search": topk_search.op4_topk_search,
    "op5_revisits": revisits.op5_revisits,
    "op6_mixing": mixing.op6_mixing,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_sharding": sharding.op9_sharding,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_secret_scan": secret_scan.op11_secret_scan,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_alignment": alignment.op13_alignment,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op4_topk_search": topk_search.ORACLE,
    "op5_revisits": revisits.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
}
