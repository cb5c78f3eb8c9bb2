"""Registered queries of the subpackage and their DuckDB oracles."""

from lakesearch.llm import bpe, fixity, line_dedup, mixing, near_dedup, periodic_runs, quality, spelling, suffix_dedup, tool_calls, topk_search, toxicity, window_dedup

QUERIES = {
    "op1_fixity": fixity.op1_fixity,
    "op2_windows": window_dedup.op2_windows,
    "op3_setsketch": near_dedup.op3_setsketch,
    "op4_bpe": bpe.op4_bpe,
    "op5_tool_calls": tool_calls.op5_tool_calls,
    "op6_topk": topk_search.op6_topk,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_suffixes": suffix_dedup.op8_suffixes,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_spelling": spelling.op11_spelling,
    "op12_lines": line_dedup.op12_lines,
    "op13_runs": periodic_runs.op13_runs,
}

ORACLES = {
    "op1_fixity": fixity.SQL,
    "op2_windows": window_dedup.SQL,
    "op3_setsketch": near_dedup.SQL,
    "op5_tool_calls": tool_calls.SQL,
    "op6_topk": topk_search.SQL,
    "op10_mixing": mixing.SQL,
    "op12_lines": line_dedup.SQL,
}
