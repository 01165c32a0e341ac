"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import alignment, audit, chat, decontaminate, fertility, licenses, line_dedup, near_copies, packing, pitman_yor, sharding, suffixes, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_packing": packing.op2_packing,
    "op3_quality_rules": fertility.op3_quality_rules,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_sharding": sharding.op5_sharding,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_jaccard_join": near_copies.op7_jaccard_join,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_license_scans": licenses.op9_license_scans,
    "op10_suffix_array_dedup": suffixes.op10_suffix_array_dedup,
    "op11_lm_scoring": pitman_yor.op11_lm_scoring,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_filter_audit": audit.op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": chat.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
