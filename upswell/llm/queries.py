"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from upswell.llm import alignment, exact_dedup, inner_products, jaccard_join, language, mixing, packing, periodic_runs, repeats, repetition, sharding, toxicity, url_filter

QUERIES = {
    "op1_language_id": language.op1,
    "op2_repeats": repeats.op2,
    "op3_packing": packing.op3,
    "op4_url_filter": url_filter.op4,
    "op5_mixing": mixing.op5,
    "op6_sharding": sharding.op6,
    "op7_exact_dedup": exact_dedup.op7,
    "op8_repetition": repetition.op8,
    "op9_toxicity": toxicity.op9,
    "op10_jaccard_join": jaccard_join.op10,
    "op11_alignment": alignment.op11,
    "op12_periodic_runs": periodic_runs.op12,
    "op13_inner_products": inner_products.op13,
}
SQL = {
    "op5_mixing": mixing.OP5_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op13_inner_products": inner_products.OP13_SQL,
}
