"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from . import collocations, conversation_repair, decontaminate, jaccard_join, license_scan, mixing, nearest, perplexity, secret_scan, sharding, suffix_dedup, toxicity, url_filter

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_sharding": sharding.op2_sharding,
    "op3_nearest": nearest.op3_nearest,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_quality_rules": perplexity.op12_quality_rules,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE_SQL = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op2_sharding": sharding.OP2_SQL,
    "op8_license_scan": license_scan.OP8_SQL,
    "op9_secret_scan": secret_scan.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_conversation_repair": conversation_repair.OP11_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
