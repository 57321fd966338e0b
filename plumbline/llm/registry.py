"""The registered queries of this package and their SQL checks."""

from __future__ import annotations

import corpus_pipeline
from plumbline.llm import queries

QUERIES = {
    "op1_near_vectors": queries.op1_near_vectors,
    "op2_chat_format": queries.op2_chat_format,
    "op3_token_counts": queries.op3_token_counts,
    "op4_license_scan": queries.op4_license_scan,
    "op5_byte_bpe": queries.op5_byte_bpe,
    "op6_url_filter": queries.op6_url_filter,
    "op7_quality_rules": queries.op7_quality_rules,
    "op8_jaccard_join": queries.op8_jaccard_join,
    "op9_toxicity": queries.op9_toxicity,
    "op10_best_fit_packing": queries.op10_best_fit_packing,
    "op11_periodic_runs": queries.op11_periodic_runs,
    "op12_token_alignment": queries.op12_token_alignment,
    "op13_suffix_family": queries.op13_suffix_family,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_near_vectors": queries.SQL_OP1,
    "op4_license_scan": queries.SQL_OP4,
    "op6_url_filter": queries.SQL_OP6,
    "op7_quality_rules": queries.SQL_OP7,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
