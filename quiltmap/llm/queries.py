"""The query of each operator, and its SQL where SQL can say it."""

from __future__ import annotations

from quiltmap.llm import exact_dedup, fingerprints, hard_negatives, html_extract, line_dedup, minhash_dedup, mixing, packing, periodic_runs, substring_dedup, tool_calls, toxicity, url_filters

QUERIES = {
    "op1_html_extraction": html_extract.op1_html_extraction,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_mixing": mixing.op3_mixing,
    "op4_packing": packing.op4_packing,
    "op5_tool_calls": tool_calls.op5_tool_calls,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_url_filters": url_filters.op8_url_filters,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_minhash_dedup": minhash_dedup.op10_minhash_dedup,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE = {
    "op5_tool_calls": tool_calls.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op10_minhash_dedup": minhash_dedup.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op12_substring_dedup": substring_dedup.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
