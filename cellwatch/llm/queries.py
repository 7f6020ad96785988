"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import (chat_format, collision_search, decontaminate, html_extract, lexical_search, lm_score, mixing, near_dups, periodic_runs,
               quality_rules, secrets_crf, token_counts, toxicity_cnn)

REGISTRY = {
    "op1_mixing": mixing.op1_mixing,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_html_extract": html_extract.op3_html_extract,
    "op4_lm_score": lm_score.op4_lm_score,
    "op5_toxicity": toxicity_cnn.op5_toxicity,
    "op6_secrets": secrets_crf.op6_secrets,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_near_dups": near_dups.op8_near_dups,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_nearest_neighbours": collision_search.op11_nearest_neighbours,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

SQL: dict[str, str] = {
    "op1_mixing": mixing.OP1_SQL,
    "op2_decontamination": decontaminate.OP2_SQL,
    "op7_chat_format": chat_format.OP7_SQL,
    "op8_near_dups": near_dups.OP8_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
