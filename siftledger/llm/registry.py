"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from siftledger.llm import (
    chat,
    edit_automata,
    hnsw,
    hpylm,
    line_runs,
    lsh_forest,
    maxscore,
    mil,
    packing,
    sharding,
    templates,
    threshold,
    token_counts,
)


def queries() -> dict:
    return {
        "op1_histogram_sort": sharding.query,
        "op2_hpylm": hpylm.query,
        "op3_lsh_forest": lsh_forest.query,
        "op4_line_runs": line_runs.query,
        "op5_attention_mil": mil.query,
        "op6_bin_completion": packing.query,
        "op7_token_counts": token_counts.query,
        "op8_hnsw": hnsw.query,
        "op9_chat_format": chat.query,
        "op10_template_decontamination": templates.query,
        "op11_edit_automata": edit_automata.query,
        "op12_threshold": threshold.query,
        "op13_maxscore": maxscore.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_runs": line_runs.SQL,
        "op9_chat_format": chat.SQL,
        "op11_edit_automata": edit_automata.SQL,
        "op12_threshold": threshold.SQL,
        "op13_maxscore": maxscore.SQL,
    }
